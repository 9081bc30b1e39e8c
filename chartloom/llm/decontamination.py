"""Operator 8: benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all 16-word blocks of all documents.
2. A randomised SVD of TF-IDF passages: tasks multiply their passages with a Gaussian
   matrix and back, the sums A'(A G) are added up, and the Nystroem form of A'A gives the
   right singular vectors. The basis is fitted on every document and every benchmark passage;
   in any number, documents weigh together at most as `FIT_WEIGHT` of them, and each benchmark
   passage as `ITEM_WEIGHT` of theirs, so a larger corpus does not crowd out the benchmark.
3. Every passage of every document (2 or 4 blocks, a new one each block) is projected, and
   each benchmark passage with a cosine of at least `cosine` is a candidate.
4. A candidate stands if the longest common subsequence of words of the region and the
   benchmark passage has `copied` of the passage, or `rephrased` of it and also `answered`
   of its answer (its last sentence).

Items of up to 24 words drown in such windows, so these are also sought by pairs of words
that follow each other: a copy with `rephrased` of the words keeps a number of them, wherever
words were replaced. Items of fewer than `least` words are sought word for word.

Items over `piece` words are searched in pieces. Items go round in groups of `group`, so
what is broadcast is bounded by parameters. Results: one row for each document row and
item found.

Defined results: null and empty text, and items without words, match nothing; no document or
no item gives an empty result; a null id is reported as null; items that share an id are one
item of several texts, all searched; each repeated document row is a row of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import mix, parts_for, prefix_hash, range_hash, trim, written

FEATURES, RANK, BLOCK, SCALES, PIECE, LEAST, GROUP = 4096, 64, 16, (2, 4), 48, 8, 5_000
COSINE, COPIED, REPHRASED, ANSWERED, FIT_WEIGHT, ITEM_WEIGHT = 0.62, 0.75, 0.65, 0.8, 4_000, 30.0
#: Characters that are worked on at a time.
SLICE = 1 << 20
#: Passages whose rows are held at a time.
PASSAGES = 128
WORD_BYTE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
SENTENCE = re.compile(r"[.?!\n]+")


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-case words (runs of letters and digits), and where each text's begin."""
    raw = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], WORD_BYTE[data], [False]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    values = np.empty(len(start), np.uint64)
    for a in range(0, len(start), 1 << 16):
        b = min(len(start), a + (1 << 16))
        low = start[a]
        c = prefix_hash(data[low : end[b - 1]].astype(np.uint64) + np.uint64(1))
        values[a:b] = range_hash(c, start[a:b] - low, end[a:b] - low)
    return values, np.searchsorted(start, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]))


def blocks_of(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each block (FEATURES where it ends early), and where each text's blocks begin."""
    sizes = np.diff(first)
    count = -(-sizes // BLOCK)
    at = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(len(values)) - np.repeat(first[:-1], sizes)
    out = np.full((int(at[-1]), BLOCK), FEATURES, np.int32)
    out[np.repeat(at[:-1], sizes) + place // BLOCK, place % BLOCK] = (values % np.uint64(FEATURES)).astype(np.int32)
    return out, at


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def block_frequencies(blocks: np.ndarray) -> np.ndarray:
    row = np.sort(blocks, axis=1)
    fresh = np.concatenate([np.ones((len(row), 1), bool), row[:, 1:] != row[:, :-1]], axis=1)
    return np.bincount(row[fresh], minlength=FEATURES + 1)[:FEATURES]


def summed(rows: DataFrame, column: str, of_texts, shape: tuple[int, ...], kind: str) -> np.ndarray:
    """Sum over all texts of an array of fixed shape: per task, then in a tree, so the driver gets few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts):
                total += of_texts(texts[a:b])
        trim()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["g", "sum"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(shape, kind)
        for blob in table.column("sum").to_pylist():
            total += np.frombuffer(blob, kind).reshape(shape)
        return pa.table({"g": pa.array([0], pa.int64()), "sum": pa.array([total.tobytes()], pa.binary())})

    sums = rows.select(column).mapInArrow(run, "g long, sum binary")
    parts = max(1, rows.rdd.getNumPartitions() // 16)
    while parts > 1:
        sums = sums.withColumn("g", F.pmod(F.xxhash64("sum"), F.lit(parts))).groupBy("g").applyInArrow(add, "g long, sum binary")
        parts //= 16
    return np.sum([np.frombuffer(r["sum"], kind).reshape(shape) for r in sums.collect()] or [np.zeros(shape, kind)], axis=0)


def gaussian() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((FEATURES, RANK)).astype(np.float32)


def range_sum(blocks: np.ndarray, at: np.ndarray, idf: np.ndarray, g: np.ndarray, weight: float = 1.0) -> np.ndarray:
    """A'(A G) of passages of four blocks, as rows of A with unit length."""
    out = np.zeros((FEATURES, g.shape[1]))
    texts = np.repeat(np.arange(len(at) - 1), np.diff(at))
    passage = np.concatenate([[0], np.cumsum((np.diff(texts) != 0) | ((np.arange(1, len(texts)) - at[texts[1:]]) % 4 == 0))]) if len(texts) else texts
    n = int(passage[-1]) + 1 if len(passage) else 0
    scaled, flat = np.append(idf, np.float32(0)), np.zeros(PASSAGES * (FEATURES + 1), np.float32)
    cuts = np.searchsorted(passage, np.arange(0, n + PASSAGES, PASSAGES))
    for a, low, high in zip(range(0, n, PASSAGES), cuts, cuts[1:], strict=False):
        place = (((passage[low:high] - a) * (FEATURES + 1))[:, None] + blocks[low:high]).ravel()
        np.add.at(flat, place, scaled[blocks[low:high].ravel()])
        rows = flat.reshape(PASSAGES, -1)[: min(PASSAGES, n - a), :FEATURES]
        seen = rows @ g
        seen *= (weight / np.maximum(np.einsum("ij,ij->i", rows, rows), 1e-18)).astype(np.float32)[:, None]
        out += rows.T @ seen
        flat[place] = 0
    return out


def right_vectors(y: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Right singular vectors of A from Y = A'A G, by the Nystroem form Y (G'Y)^-1 Y'."""
    core = g.T.astype(np.float64) @ y
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core)
    keep = value > max(value.max(), 0) * 1e-9
    if not keep.any():
        return np.zeros((FEATURES, RANK), np.float32)
    u, s, _ = np.linalg.svd((y @ vector[:, keep]) / np.sqrt(value[keep]), full_matrices=False)
    out = np.zeros((FEATURES, RANK), np.float32)  # fewer dimensions than RANK leave zeros
    out[:, : u.shape[1]] = u * (s > 1e-9)
    return out


class Passages(NamedTuple):
    """Benchmark passages: the item of each, words, the answer's words, and their latent vectors.

    Of passage p, `ids` from bounds[p] to bounds[p + 1] are its distinct words' places in `vocabulary`, `times` how often it has them.
    """

    item: list[int | None]
    words: list[tuple[int, ...]]
    answer: list[tuple[int, ...]]
    scale: np.ndarray
    vectors: np.ndarray
    exact: list[tuple[int | None, np.ndarray]]
    pairs: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    vocabulary: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    bounds: np.ndarray


def followers(values: np.ndarray) -> np.ndarray:
    """Hashes of each word and the next."""
    return mix(mix(values[:-1]) + values[1:])


def passages_of(items: list[tuple[int | None, str]], table: np.ndarray) -> Passages:
    item, words, answers, scale, vectors, exact, pairs = [], [], [], [], [], [], []
    for number, text in items:
        values, _ = word_hashes([text])
        if len(values) < LEAST:
            if len(values):
                exact.append((number, values))
            continue
        sentences = [s for s in SENTENCE.split(text) if len(word_hashes([s])[0])]
        tail = word_hashes([sentences[-1]])[0]
        tail = tail if 3 <= len(tail) < len(values) else values[-8:]
        pieces = np.array_split(values, parts_for(len(values), PIECE))
        for i, piece in enumerate(pieces):
            if len(piece) <= SCALES[0] * BLOCK * 3 // 4:
                pairs += [(int(v), len(item), o) for o, v in enumerate(followers(piece))]
            item.append(number)
            words.append(tuple(piece.tolist()))
            answers.append(tuple(tail.tolist()) if i == len(pieces) - 1 else ())
            scale.append(SCALES[0] if len(piece) <= SCALES[0] * BLOCK * 3 // 4 else SCALES[1])
            v = table[(piece % np.uint64(FEATURES)).astype(np.int64)].sum(axis=0)
            vectors.append(v / max(np.linalg.norm(v), 1e-9))
    pairs.sort()
    value, owner, offset = (np.array([x[i] for x in pairs], kind) for i, kind in enumerate((np.uint64, np.int64, np.int64)))
    each = [np.unique(np.array(w, np.uint64), return_counts=True) for w in words]
    vocabulary, ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *(v for v, _ in each)]), return_inverse=True)
    times, bounds = np.concatenate([np.zeros(0, np.int16), *(n.astype(np.int16) for _, n in each)]), np.cumsum([0, *(len(v) for v, _ in each)])
    return Passages(item, words, answers, np.array(scale, np.int64), np.array(vectors, np.float32).reshape(len(item), table.shape[1]), exact, value, owner, offset, vocabulary, ids.astype(np.int32), times, bounds)


def common_subsequence(a: tuple[int, ...], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits of a."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & masks.get(y, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def candidates(z: np.ndarray, at: np.ndarray, passages: Passages, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(first block, passage) of all windows whose cosine is high enough."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    window, reach, found = z.copy(), 1, []
    for scale in SCALES:
        for k in range(reach, scale):
            same = np.flatnonzero(text[k:] == text[:-k])
            window[same] += z[same + k]
        reach = scale
        own = np.flatnonzero(passages.scale == scale)
        if not len(own):
            continue
        unit = window / np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
        for a in range(0, len(unit), 4096):
            i, j = np.divmod(np.flatnonzero(unit[a : a + 4096] @ passages.vectors[own].T >= cosine), len(own))
            found.append((i + a, own[j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def thinned(text: np.ndarray, passage: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which candidates, in order of text, passage and first block, to look at: the region of the one before holds a next block's."""
    begins = np.ones(len(start), bool)
    begins[1:] = (text[1:] != text[:-1]) | (passage[1:] != passage[:-1]) | (start[1:] != start[:-1] + 1)
    run = np.flatnonzero(begins)
    return (np.arange(len(start)) - np.repeat(run, np.diff(np.append(run, len(start))))) % 2 == 0


def places(values: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word its place in the vocabulary, beyond it if it has none, and where a word of the vocabulary stood last before."""
    place, previous = np.full(len(values), len(vocabulary), np.int32), np.full(len(values), -1, np.int64)
    known, mask = np.zeros(1 << 16, bool), np.uint64((1 << 16) - 1)  # most words are told by their last bits
    known[vocabulary & mask] = True
    at = np.flatnonzero(known[values & mask])
    found = np.searchsorted(vocabulary, values[at])
    ok = vocabulary[np.minimum(found, len(vocabulary) - 1)] == values[at]
    at, found = at[ok], found[ok].astype(np.min_scalar_type(len(vocabulary)))
    place[at] = found
    order = np.argsort(found, kind="stable")
    same = np.flatnonzero(found[order[1:]] == found[order[:-1]])
    previous[at[order[same + 1]]] = at[order[same]]
    return place, previous


def words_held(values: np.ndarray, begin: np.ndarray, end: np.ndarray, passage: np.ndarray, passages: Passages) -> np.ndarray:
    """Of each region and passage, how many of the passage's words are words of the region: no common subsequence is longer."""
    out = np.zeros(len(begin), np.int64)
    if not len(begin):
        return out
    place, previous = places(values, passages.vocabulary)
    weight, reach = np.zeros(len(passages.vocabulary) + 1, np.int64), np.arange(int((end - begin).max()))
    order = np.argsort(passage, kind="stable")
    cuts = np.flatnonzero(np.diff(passage[order], prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        p = int(passage[order[a]])
        own = slice(passages.bounds[p], passages.bounds[p + 1])
        weight[passages.ids[own]] = passages.times[own]
        for c in range(a, b, 1024):
            some = order[c : min(b, c + 1024)]
            at = begin[some, None] + reach
            inside = at < end[some, None]
            at = np.minimum(at, len(values) - 1)
            inside &= previous[at] < begin[some, None]  # a word counts where it stands first
            out[some] = (weight[place[at]] * inside).sum(axis=1)
        weight[passages.ids[own]] = 0
    return out


def word_for_word(values: np.ndarray, first: np.ndarray, passages: Passages) -> Iterator[tuple[int, int | None]]:
    """(text, item) of the items of few words."""
    if not passages.exact or not len(values):
        return
    order = np.argsort(values, kind="stable")
    known = values[order]
    for number, words in passages.exact:
        low, high = np.searchsorted(known, words[0]), np.searchsorted(known, words[0], side="right")
        at = order[low:high]
        for k in range(1, len(words)):
            at = at[at + k < len(values)]
            at = at[values[at + k] == words[k]]
        text = np.searchsorted(first, at, side="right") - 1
        for t in np.unique(text[at + len(words) <= first[text + 1]]).tolist():
            yield t, number


def short_candidates(values: np.ndarray, first: np.ndarray, passages: Passages) -> Iterator[tuple[int, int, int, int]]:
    """(text, passage, region's begin and end) where enough pairs of following words of a short passage lie close."""
    if not len(passages.pairs) or len(values) < 2:
        return
    pair = followers(values)
    known, mask = np.zeros(1 << 16, bool), np.uint64((1 << 16) - 1)  # most pairs are told by their last bits
    known[passages.pairs & mask] = True
    at = np.flatnonzero(known[pair & mask])
    low, high = (np.searchsorted(passages.pairs, pair[at], side=side) for side in ("left", "right"))
    n = high - low
    entry = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
    at, p, offset = np.repeat(at, n), passages.owner[entry], passages.offset[entry]
    order = np.lexsort((at, p))
    at, p, offset = at[order], p[order], offset[order]
    length = np.array([len(w) for w in passages.words], np.int64)
    # words replaced cost two pairs each
    lost = length - np.ceil(min(REPHRASED, COPIED) * length - 1e-9).astype(np.int64)
    need = np.maximum(1, length - 1 - 2 * lost)[p]
    last = np.arange(len(at)) + need - 1
    ok = last < len(at)
    last = np.minimum(last, max(0, len(at) - 1))
    ok &= (p[last] == p) & (at[last] - at <= 2 * length[p])
    for i in np.flatnonzero(ok).tolist():
        j, size = int(p[i]), int(length[p[i]])
        t, begin, margin = int(np.searchsorted(first, at[i], side="right")) - 1, int(at[i] - offset[i]), max(2, size // 4)
        yield t, j, max(int(first[t]), begin - margin), min(int(first[t + 1]), begin + size + 2 * margin)


def verified(texts: list[str | None], table: np.ndarray, passages: Passages, cosine: float) -> Iterator[tuple[int, int | None, float, float]]:
    """(text, item, share copied, share of the answer) of the candidates that stand; of each text and item the best."""
    values, first = word_hashes(texts)
    blocks, at = blocks_of(values, first)
    z = np.concatenate([table[blocks[a : a + 1024]].sum(axis=1) for a in range(0, len(blocks), 1024)]) if len(blocks) else np.zeros((0, table.shape[1]), np.float32)
    start, passage = candidates(z, at, passages, cosine)
    text = np.searchsorted(at, start, side="right") - 1
    order = np.lexsort((start, passage, text))
    order = order[thinned(text[order], passage[order], start[order])]
    start, passage, text = start[order], passage[order], text[order]
    low = (start - at[text] - 1) * BLOCK
    begin, end = first[text] + np.maximum(0, low), np.minimum(first[text + 1], first[text] + low + (passages.scale[passage] + 4) * BLOCK)
    length = np.array([len(w) for w in passages.words], np.int64)[passage]
    likely = np.flatnonzero(words_held(values, begin, end, passage, passages) >= min(REPHRASED, COPIED) * length)
    best: dict[tuple[int, int | None], tuple[float, float, int]] = {}
    for t, p, a, b in zip(*(x[likely].tolist() for x in (text, passage, begin, end)), strict=True):
        words, own = passages.words[p], values[a:b].tolist()
        share = common_subsequence(words, own) / len(words)
        answer = common_subsequence(passages.answer[p], own) / len(passages.answer[p]) if passages.answer[p] else 0.0
        if share >= COPIED or share >= REPHRASED and answer >= ANSWERED:
            key = (t, passages.item[p])
            if key not in best or best[key][:2] < (share, answer):
                best[key] = (share, answer, p)
    for t, p, low, high in short_candidates(values, first, passages):
        key, words, own = (t, passages.item[p]), passages.words[p], values[low:high].tolist()
        if best.get(key, (0.0,))[0] == 1.0:
            continue
        share = common_subsequence(words, own) / len(words)
        if share < min(REPHRASED, COPIED):
            continue
        answer = common_subsequence(passages.answer[p], own) / len(passages.answer[p]) if passages.answer[p] else 0.0
        if (share >= COPIED or answer >= ANSWERED) and (key not in best or best[key][:2] < (share, answer)):
            best[key] = (share, answer, p)
    for t, number in word_for_word(values, first, passages):
        best[t, number] = (1.0, 1.0, -1)
    for (t, number), (share, answer, _) in best.items():
        yield t, number, share, answer


def latent_decontamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", cosine: float = COSINE, row_key: Column | None = None) -> DataFrame:
    """(doc_id, item_id, copied, answered) for each document row and item found in it, and row_key (of text) to tell rows of one id apart."""
    spark = docs.sparkSession
    key = F.lit("") if row_key is None else row_key
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), key.alias("row_key")).where(F.octet_length("text") > 0)
    items = benchmark.where(F.octet_length(item_text) > 0).select(F.col(item_column).cast("long").alias("item"), F.col(item_text).alias("text")).distinct()
    kept = written(items.withColumn("group", F.pmod(F.xxhash64(F.coalesce("item", F.xxhash64("text"))), F.lit(parts_for(items.count(), GROUP)))), "items")

    counted = summed(rows, "text", lambda texts: np.append(block_frequencies(blocks_of(*word_hashes(texts))[0]), len(texts)), (FEATURES + 1,), "int64")
    df, share = counted[:FEATURES], min(1.0, FIT_WEIGHT / max(1, int(counted[FEATURES])))
    idf = np.log((df.max(initial=0) + 2.0) / (df + 1.0)).astype(np.float32)
    g = gaussian()
    fit = lambda weight: lambda texts: range_sum(*blocks_of(*word_hashes(texts)), idf, g, weight)
    y = summed(rows, "text", fit(share), (FEATURES, RANK), "float64") + summed(kept, "text", fit(ITEM_WEIGHT), (FEATURES, RANK), "float64")
    basis = np.concatenate([right_vectors(y, g) * idf[:, None], np.zeros((1, RANK), np.float32)])

    found, fields = None, "doc_id long, item_id long, copied double, answered double, row_key string"
    for group in sorted(r["group"] for r in kept.select("group").distinct().collect()):
        own = [(r["item"], r["text"]) for r in kept.where(F.col("group") == group).select("item", "text").orderBy("item", "text").collect()]
        passages = passages_of(own, basis)

        def run(batches: Iterator[pa.RecordBatch], passages: Passages = passages) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                (ids, texts, keys), out = (batch.column(i).to_pylist() for i in range(3)), []
                for a, b in slices(texts):
                    out += [(ids[a + t], number, share, answer, keys[a + t]) for t, number, share, answer in verified(texts[a:b], basis, passages, cosine)]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()), strict=True)], ["doc_id", "item_id", "copied", "answered", "row_key"])

        part = rows.mapInArrow(run, fields)
        found = part if found is None else found.unionByName(part)
    found = found if found is not None else spark.createDataFrame([], fields)
    return found if row_key is not None else found.drop("row_key")
