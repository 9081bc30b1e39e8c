"""Operator 1: exact substring removal by suffix sorting with bucket-pointer refinement.

Windows are judged on the input: a byte goes if a window of `length` bytes covers it
that also starts in a document of smaller id. Matches never cross documents.

Defined results: null or empty text has no bytes and keeps none; a null id counts as
larger than any other; rows of one id are no smaller than each other, so neither
removes the other's bytes; an empty table gives an empty result; other columns pass
through, those named like a result give way to it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.repeats import Chunk, byte_units, remove_repeats, window_mask

QGRAM = 8


def refine(bucket: np.ndarray, active: np.ndarray, offset: int, room: np.ndarray, depth: int) -> np.ndarray:
    """Sort members of shared buckets on the bucket `offset` further on; returns those that still share one.

    bucket holds, for each suffix, where its bucket begins in suffix order. Entries are
    updated in place, so the next call reads the finer ones.
    """
    active = active[room[active] >= depth]
    if not len(active):
        return active
    key = (bucket[active].astype(np.uint64) << np.uint64(32)) | bucket[active + offset].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key, active = key[order], active[order]
    i = np.arange(len(key))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    outer = np.concatenate([[True], (key[1:] >> np.uint64(32)) != (key[:-1] >> np.uint64(32))])
    inner = np.maximum.accumulate(np.where(fresh, i, 0)) - np.maximum.accumulate(np.where(outer, i, 0))
    bucket[active] += inner
    again = ~fresh | np.append(~fresh[1:], False)
    return active[again]


def suffix_buckets(data: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Bucket of each suffix with room for `length` bytes: equal for equal first `length` bytes, and else different.

    Initial buckets are q-grams of 8 bytes. Each pass sorts on bucket numbers at a later
    offset and so doubles the depth; suffixes alone in their bucket are final and sorted no more.
    """
    n, q = len(data), min(QGRAM, length)
    packed = np.zeros(n, np.uint64)
    wide = np.concatenate([data, np.zeros(q, np.uint8)]).astype(np.uint64)
    for i in range(q):
        packed = (packed << np.uint64(8)) | wide[i : n + i]
    at = np.flatnonzero(room >= q)
    order = at[np.argsort(packed[at], kind="stable")]
    sorted_q = packed[order]
    fresh = np.concatenate([[True], sorted_q[1:] != sorted_q[:-1]]) if len(order) else np.zeros(0, bool)
    bucket = np.full(n, -1, np.int64)
    bucket[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)) if len(order) else 0
    active = order[~fresh | np.append(~fresh[1:], False)] if len(order) else order
    depth = q
    while depth < length:
        offset = min(depth, length - depth)
        active = refine(bucket, active, offset, room, depth + offset)
        depth += offset
    return bucket


def match_bytes(texts: list[bytes], docs: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Bits of the windows of each record that start in a record of a smaller document."""
    distinct: dict[bytes, int] = {}
    of = np.array([distinct.setdefault(t, len(distinct)) for t in texts], np.int64)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, of, docs)
    keys = list(distinct)
    sizes = np.array([len(t) for t in keys], np.int64)
    data = np.frombuffer(b"".join(keys), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    room = np.repeat(first + sizes, sizes) - np.arange(len(data))
    bucket = suffix_buckets(data, room, length)
    at = np.flatnonzero(room >= length)
    record = np.repeat(np.arange(len(keys)), sizes)[at]
    mask = window_mask(bucket[at], least[record], record, at - first[record], len(keys))[of]
    full = (np.uint64(1) << counts.astype(np.uint64)) - np.uint64(1)
    return np.where(docs > least[of], full, mask)


def spans_of(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"start": a, "length": b - a} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]


def finish_bytes(chunk: Chunk, removed: np.ndarray):
    first = chunk.seq.first.tolist()
    for i, text in enumerate(chunk.texts):
        flags = removed[first[i] : first[i + 1]]
        if flags.any():
            kept = np.frombuffer(text, np.uint8)[~flags].tobytes()
            yield len(text), spans_of(flags), kept, kept.decode("utf-8", "ignore")
        else:
            yield len(text), [], text, text.decode("utf-8", "ignore")


def suffix_array_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 50, gram: int = 20) -> DataFrame:
    """docs plus n_bytes, spans (removed runs), kept (the bytes left) and kept_text (without torn characters)."""
    fields = "n_bytes long, spans array<struct<start: long, length: long>>, kept binary, kept_text string"
    return remove_repeats(docs, id_column, text_column, byte_units, length, gram, match_bytes, finish_bytes, fields)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """The digest in DuckDB SQL: every 50-byte string with the least document it starts in."""
    return """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n_bytes FROM t),
s AS (SELECT doc_id, i, array_slice(b, i, i + 49) AS g FROM (SELECT doc_id, b, unnest(range(1, n_bytes - 48)) AS i FROM n)),
l AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g HAVING count(*) > 1),
w AS (SELECT s.doc_id, s.i FROM s JOIN l USING (g) WHERE l.least < s.doc_id),
p AS (SELECT doc_id, unnest(range(1, n_bytes + 1)) AS i FROM n),
c AS (SELECT p.doc_id, p.i, count(w.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone FROM p LEFT JOIN w ON p.doc_id = w.doc_id AND p.i = w.i),
e AS (SELECT doc_id, i, gone, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM c),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT before) AS n_spans FROM e GROUP BY doc_id),
k AS (SELECT c.doc_id, string_agg(hex(array_slice(n.b, c.i, c.i)), '' ORDER BY c.i) AS h FROM c JOIN n USING (doc_id) WHERE NOT c.gone GROUP BY c.doc_id)
SELECT n.doc_id, n.n_bytes::BIGINT AS n_bytes, coalesce(a.n_removed, 0)::BIGINT AS n_removed, coalesce(a.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM n LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)
"""
