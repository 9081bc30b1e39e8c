"""Exact repeated windows across documents, found in shards.

Every window of `length` units (bytes or words) has an anchor: the smallest hash
among its `gram`-unit grams. Equal windows have equal anchors, so:

1. documents are dealt into chunks by a hash of their id;
2. chunks send their distinct anchor hashes to shards, by hash range, and get back
   one bit each: does another document have that anchor?
3. records (the runs of windows of one repeated anchor, as plain text, once per
   chunk and content) go to shards, where a `matcher` compares whole windows;
   a bit per window comes back: does it start in a document of smaller id?
4. chunks turn those bits into removed units.

What is shuffled: the texts once (the exchange is reused by 2, 3 and 4), six bytes
an anchor, and the records of repeated anchors. One anchor in a third of all
documents is one record a chunk, not one a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import (
    LAST_ID, binary_rows, giving_way, mix, packed_bits, parts_for, positional, prefix_hash, range_hash, total_bytes, trim, unpacked_bits,
)

#: Window starts that are hashed at a time: bounds the memory of one very long text.
SLICE = 1 << 16
LOW = np.uint64(0xFFFF)
CHUNK_BYTES, ANCHOR_BYTES, RECORD_BYTES, MATCH_BYTES = 4 << 20, 16 << 20, 4 << 20, 1 << 20
ANCHORS = "chunk long, shard long, kind int, blob binary"


@dataclass
class Sequence:
    """The units of a chunk's documents, one document after the other."""

    data: np.ndarray  # the bytes
    values: np.ndarray  # a number for each unit
    first: np.ndarray  # unit where each document begins, and the end
    ids: np.ndarray  # of each document
    start: np.ndarray | None = None  # byte where each unit begins (None: units are bytes)
    end: np.ndarray | None = None


def byte_units(texts: list[bytes], ids: np.ndarray) -> Sequence:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return Sequence(data, data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), ids)


def word_units(texts: list[bytes], ids: np.ndarray) -> Sequence:
    """Words are runs of anything but the six ASCII white space bytes."""
    data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    values = np.empty(len(start), np.uint64)
    for a in range(0, len(start), SLICE):  # a slice of words at a time
        b = min(len(start), a + SLICE)
        low, high = start[a], end[b - 1]
        c = prefix_hash(data[low:high].astype(np.uint64) + np.uint64(1))
        values[a:b] = range_hash(c, start[a:b] - low, end[a:b] - low)
    return Sequence(data, values, np.searchsorted(start, at).astype(np.int64), ids, start, end)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - have : width - have + len(x) - width + 1]) if have < width else out


@dataclass
class Records:
    """Runs of windows with one anchor: windows first .. first + count - 1."""

    anchor: np.ndarray  # 48-bit hash
    first: np.ndarray
    count: np.ndarray
    content: np.ndarray  # 64-bit hash of all units covered: proposes equal records, never decides
    doc: np.ndarray  # index of the document


def records_of(seq: Sequence, length: int, gram: int) -> Records:
    n, width = len(seq.values), length - gram + 1
    parts: list[tuple[np.ndarray, ...]] = []
    for a in range(0, max(0, n - length + 1), SLICE):
        b = min(n - length + 1, a + SLICE)
        c = prefix_hash(seq.values[a : b + length - 1].astype(np.uint64) + np.uint64(1))
        grams = np.arange(len(c) - gram, dtype=np.int64)
        h = range_hash(c, grams, grams + gram)
        least = sliding_min((h & ~LOW) | (grams.astype(np.uint64) & LOW), width)
        doc = np.searchsorted(seq.first, np.arange(a, b), side="right") - 1
        inside = np.arange(a, b) + length <= seq.first[doc + 1]
        fresh = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
        at = np.flatnonzero(fresh & inside)
        if not len(at):
            continue
        stop = np.append(np.flatnonzero(fresh)[1:], b - a)[np.searchsorted(np.flatnonzero(fresh), at)]
        stop = np.minimum(stop, seq.first[doc[at] + 1] - length + 1 - a)
        anchor = mix(least[at] >> np.uint64(16)) >> np.uint64(16)  # smallest hashes are not spread evenly; these are
        parts.append((anchor, at + a, stop - at, range_hash(c, at, stop + length - 1), doc[at]))
    if not parts:
        none = np.zeros(0, np.int64)
        return Records(none.astype(np.uint64), none, none, none.astype(np.uint64), none)
    return Records(*(np.concatenate(x) for x in zip(*parts, strict=True)))


class Chunk:
    """One chunk's documents in order of id (nulls last), and what each side of an exchange can work out again."""

    def __init__(self, rows: pa.Table, id_column: str, text_column: str, units: Callable, length: int, gram: int, shards: tuple[int, int]) -> None:
        ids = np.array([LAST_ID if x is None else x for x in rows.column(id_column).to_pylist()], np.int64)
        texts = binary_rows(rows.column(text_column))
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.seq = units(self.texts, ids[self.order])
        self.length, self.gram, self.shards = length, gram, shards
        self.records = records_of(self.seq, length, gram)
        self.anchors, first, self.of = np.unique(self.records.anchor, return_index=True, return_inverse=True)
        ids = self.seq.ids[self.records.doc]
        self.shared = np.zeros(len(self.anchors), bool)  # in two documents of this chunk
        self.shared[self.of[ids != ids[first][self.of]]] = True

    def cuts(self, which: int) -> np.ndarray:
        n = self.shards[which]
        return np.array([(i << 48) // n for i in range(n + 1)], np.uint64)

    def anchor_blobs(self) -> Iterator[tuple[int, bytes]]:
        at = np.searchsorted(self.anchors, self.cuts(0))
        for shard in np.flatnonzero(np.diff(at)):
            own = self.anchors[at[shard] : at[shard + 1]]
            six = own.view(np.uint8).reshape(-1, 8)[:, :6]
            yield int(shard), np.uint32(len(own)).tobytes() + six.tobytes() + packed_bits(self.shared[at[shard] : at[shard + 1]])

    def repeated(self, blobs: dict[int, bytes]) -> np.ndarray:
        at, out = np.searchsorted(self.anchors, self.cuts(0)), np.zeros(len(self.anchors), bool)
        for shard, blob in blobs.items():
            out[at[shard] : at[shard + 1]] = unpacked_bits(blob, at[shard + 1] - at[shard])
        return out

    def sent(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Records of repeated anchors; of each content the first one's index among the sent; the sent by shard; where shards begin."""
        r = np.flatnonzero(repeated[self.of])
        first, back = np.unique(self.equal_text(r), return_inverse=True)
        send = r[first]  # the first has the smallest id
        by = np.argsort(self.records.anchor[send], kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        return r, place[back], send[by], np.searchsorted(self.records.anchor[send[by]], self.cuts(1))

    def place_of(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of records."""
        s, rec = self.seq, self.records
        low, high = rec.first[r], rec.first[r] + rec.count[r] + self.length - 1
        return (low, high) if s.start is None else (s.start[low], s.end[high - 1])

    def equal_text(self, r: np.ndarray) -> np.ndarray:
        """For each of the records the place in r of the first one of the same bytes. Hashes propose, bytes decide."""
        _, first, back = np.unique(self.records.content[r], return_index=True, return_inverse=True)
        same, (low, high) = first[back], self.place_of(r)
        data, other = memoryview(self.seq.data), {}
        for i in np.flatnonzero(same != np.arange(len(r))).tolist():
            j, own = same[i], data[low[i] : high[i]]
            if own != data[low[j] : high[j]]:
                same[i] = other.setdefault(own.tobytes(), i)
        return same

    def record_blobs(self, repeated: np.ndarray) -> Iterator[tuple[int, bytes]]:
        _, _, send, at = self.sent(repeated)
        s, rec = self.seq, self.records
        low, high = self.place_of(send)
        data = memoryview(s.data)
        for shard in np.flatnonzero(np.diff(at)):
            own = slice(at[shard], at[shard + 1])
            text = b"".join(data[a:b] for a, b in zip(low[own].tolist(), high[own].tolist(), strict=True))
            yield int(shard), b"".join((
                np.uint32(at[shard + 1] - at[shard]).tobytes(), rec.anchor[send[own]].tobytes(), s.ids[rec.doc[send[own]]].tobytes(),
                rec.count[send[own]].astype(np.uint32).tobytes(), (high[own] - low[own]).astype(np.uint32).tobytes(), text,
            ))

    def removed(self, repeated: np.ndarray, masks: dict[int, bytes]) -> np.ndarray:
        """A flag for each unit that a window of an earlier document covers."""
        r, place, send, at = self.sent(repeated)
        rec = self.records
        mask = np.zeros(len(send), np.uint64)
        for shard, blob in masks.items():
            mask[at[shard] : at[shard + 1]] = np.frombuffer(blob, np.uint64)
        mine, theirs = self.seq.ids[rec.doc[r]], self.seq.ids[rec.doc[send[place]]] if len(r) else np.zeros(0, np.int64)
        full = (np.uint64(1) << rec.count[r].astype(np.uint64)) - np.uint64(1)
        bits = np.where(theirs < mine, full, mask[place] if len(r) else full)
        edge = np.zeros(len(self.seq.values) + 1, np.int32)
        for i in range(self.length - self.gram + 1):
            hit = rec.first[r[(bits >> np.uint64(i)) & np.uint64(1) == 1]] + i
            edge[hit] += 1
            edge[hit + self.length] -= 1
        return np.cumsum(edge[:-1]) > 0


def shared_anchors(rows: pa.Table) -> pa.Table:
    """Answer each chunk's hashes with a bit: in two documents or more?"""
    blobs = rows.column("blob").to_pylist()
    hashes, shared, sizes = [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, np.uint32, 1)[0])
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 4).reshape(n, 6)
        hashes.append(wide.view(np.uint64).ravel())
        shared.append(unpacked_bits(blob[4 + 6 * n :], n))
        sizes.append(n)
    every, flags = np.concatenate(hashes), np.concatenate(shared)
    _, back, count = np.unique(every, return_inverse=True, return_counts=True)
    several = count > 1  # chunks send a hash once, so two of them are two documents
    several[back[flags]] = True
    out = np.split(several[back], np.cumsum(sizes)[:-1])
    return pa.table({"chunk": rows.column("chunk"), "shard": rows.column("shard"), "kind": pa.array([0] * len(blobs), pa.int32()), "blob": pa.array([packed_bits(x) for x in out], pa.binary())})


def matched(rows: pa.Table, matcher: Callable, length: int) -> pa.Table:
    """Answer each chunk's records with a bit for each window: does it start in a document of smaller id?"""
    blobs = rows.column("blob").to_pylist()
    anchor, doc, count, size, text, sent = [], [], [], [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, np.uint32, 1)[0])
        anchor.append(np.frombuffer(blob, np.uint64, n, 4))
        doc.append(np.frombuffer(blob, np.int64, n, 4 + 8 * n))
        count.append(np.frombuffer(blob, np.uint32, n, 4 + 16 * n))
        size.append(np.frombuffer(blob, np.uint32, n, 4 + 20 * n))
        text.append(blob[4 + 24 * n :])
        sent.append(n)
    anchors, docs, counts, sizes = map(np.concatenate, (anchor, doc, count, size))
    data = np.frombuffer(b"".join(text), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    order = np.argsort(anchors, kind="stable")
    reach, mask = np.cumsum(sizes[order], dtype=np.int64), np.zeros(len(order), np.uint64)
    new = np.append(np.flatnonzero(np.diff(anchors[order])) + 1, len(order))
    a = 0
    while a < len(order):  # whole anchors, about MATCH_BYTES at a time
        full = np.searchsorted(reach, (reach[a - 1] if a else 0) + MATCH_BYTES, side="right")
        b = int(new[max(np.searchsorted(new, full, side="right") - 1, np.searchsorted(new, a, side="right"))])
        own = order[a:b]
        mask[own] = matcher([data[at[i] : at[i + 1]].tobytes() for i in own.tolist()], docs[own], counts[own].astype(np.int64), length)
        a = b
    out = np.split(mask, np.cumsum(sent)[:-1])
    return pa.table({"chunk": rows.column("chunk"), "shard": rows.column("shard"), "kind": pa.array([1] * len(blobs), pa.int32()), "blob": pa.array([x.tobytes() for x in out], pa.binary())})


def window_mask(group: np.ndarray, doc: np.ndarray, record: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Bits by record, from windows with the group of their content, document, record and place in it."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    mask = np.zeros(n, np.uint64)
    if len(g):
        least = np.minimum.reduceat(doc[order], first)
        hit = order[doc[order] > np.repeat(least, np.diff(np.append(first, len(g))))]
        np.bitwise_or.at(mask, record[hit], np.uint64(1) << place[hit].astype(np.uint64))
    return mask


def remove_repeats(docs: DataFrame, id_column: str, text_column: str, units: Callable, length: int, gram: int, matcher: Callable, finish: Callable, out_fields: str) -> DataFrame:
    """Apply steps 1 to 4. finish(chunk, removed) yields, per document in the chunk's order, the values of out_fields."""
    if length - gram + 1 > 63:
        raise ValueError("a record must have fewer than 64 windows")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    extra = StructType.fromDDL(out_fields)
    docs = giving_way(docs, *extra.fieldNames())
    plain, names = positional(docs)
    key, text = f"_c{names.index(id_column)}", f"_c{names.index(text_column)}"
    size = total_bytes(docs, text_column)
    chunks, shards = parts_for(size, CHUNK_BYTES), (parts_for(size, ANCHOR_BYTES), parts_for(size, RECORD_BYTES))
    dealt = plain.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce(key, F.xxhash64(text))), F.lit(chunks)))

    def chunk_of(rows: pa.Table) -> Chunk:
        return Chunk(rows, key, text, units, length, gram, shards)

    def blobs(number: int, kind: int, pairs: list[tuple[int, bytes]]) -> pa.Table:
        return pa.table({"chunk": pa.array([number] * len(pairs), pa.int64()), "shard": pa.array([s for s, _ in pairs], pa.int64()), "kind": pa.array([kind] * len(pairs), pa.int32()), "blob": pa.array([b for _, b in pairs], pa.binary())})

    def told(rows: pa.Table, kind: int) -> dict[int, bytes]:
        return {s: b for s, k, b in zip(*(rows.column(x).to_pylist() for x in ("shard", "kind", "blob")), strict=True) if k == kind}

    def send_anchors(rows: pa.Table) -> pa.Table:
        return blobs(rows.column("chunk")[0].as_py(), 0, list(chunk_of(rows).anchor_blobs()))

    def send_records(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return blobs(0, 1, [])
        chunk = chunk_of(rows)
        return blobs(rows.column("chunk")[0].as_py(), 1, list(chunk.record_blobs(chunk.repeated(told(answers, 0)))))

    def done(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = chunk_of(rows)
        removed = chunk.removed(chunk.repeated(told(answers, 0)), told(answers, 1))
        kept = rows.drop_columns(["chunk"]).take(pa.array(chunk.order, pa.int64())) if rows.num_rows else rows.drop_columns(["chunk"])
        found = list(zip(*finish(chunk, removed), strict=True)) or [[] for _ in result.fields[len(names) :]]
        for field, column in zip(arrow.names, found, strict=True):
            kept = kept.append_column(field, pa.array(column, arrow.field(field).type))
        return kept

    def light(f: Callable) -> Callable:
        def run(*tables: pa.Table) -> pa.Table:
            try:
                return f(*tables)
            finally:
                trim()

        return (lambda rows: run(rows)) if f.__code__.co_argcount == 1 else (lambda rows, answers: run(rows, answers))

    arrow, result = to_arrow_schema(extra), StructType(plain.schema.fields + extra.fields)
    anchors = dealt.groupBy("chunk").applyInArrow(light(send_anchors), ANCHORS)
    answers = anchors.groupBy("shard").applyInArrow(light(shared_anchors), ANCHORS)
    records = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(light(send_records), ANCHORS)
    masks = records.groupBy("shard").applyInArrow(light(lambda rows: matched(rows, matcher, length)), ANCHORS)
    out = dealt.groupBy("chunk").cogroup(answers.unionByName(masks).groupBy("chunk")).applyInArrow(light(done), result)
    return out.toDF(*names, *[f.name for f in extra.fields])
