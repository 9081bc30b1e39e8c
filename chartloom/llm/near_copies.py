"""Operator 5 by similarity: SimHash fingerprints and rare shingles to meet, wider fingerprints to sift, texts to decide.

A document is the set of its shingles. Documents meet in two ways. First as in op5_simhash:
64-bit fingerprints within `RADIUS` bits, through covering masks. No search of so few bits
reaches all pairs of a similarity as low as 0.8 (about 10 of 64 bits differ there), so the
rest meets through shingles. Two sets of Jaccard similarity `similarity` or more
share one of their rarest shingles: in any one order of all shingles, the first n -
ceil(similarity n) + 1 of the n shingles of each. So documents meet in the buckets of
these, in the order of a table of counts of hashed shingles; no similar pair is missed,
and rare shingles keep the buckets small. In a bucket, SimHash fingerprints of `width`
words, each from its own mixing of the shingles' hashes, tell which pairs may be similar:
of random hyperplanes, the share that parts two documents is their angle over pi, and sets
of Jaccard similarity s have a cosine of 2s / (1 + s). Texts decide every link.

Equal sets (by a digest of 128 bits) are made one class first, so a group of copies is one.
Only documents that share a bucket take part further, and buckets of equal members count
once. Each bucket yields links that connect those of its members that may be similar, one a
member at most. Components of all links are clusters: similar documents are in one cluster.
Each cluster's texts then come together once, in one task, and there every document meets
all that may be similar and are not in its group yet; one that its text bears out joins the
group. So no pairs leave a task, and pairs that resemble each other nearly enough, but not
enough, are no rows. A task holds the texts of one cluster at a time.

Rows are told apart by id and text (an md5 of it), so different texts under one id are
different documents. Of each group one stays: the smallest id, of equal ids the smallest md5.

Defined results: texts without words (null, empty) are copies of each other; fewer words
than a shingle give one shingle of all words; an empty table gives an empty result;
repeated rows get equal results; rows with a null id have a null group and stay. Sets of under `FEW` shingles are not sifted: their bits differ more than those of long texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import PRIME, binary_rows, forget_models, mix, trim, written
from chartloom.llm.decontamination import summed
from chartloom.llm.graph import components
from chartloom.llm.simhash import BITS, chain_end, fingerprint_links

WORDS, WIDTH, SIMILARITY = 5, 12, 0.8
SHINGLES_AT_ONCE, DOCUMENTS_AT_ONCE = 4096, 1024
#: Standard deviations of the share of differing bits: pairs this far above the limit need no check.
HOPELESS = 4
#: Fingerprints of sets of fewer shingles tell too little.
FEW = 32
#: Counters of hashed shingles.
COUNTERS = 1 << 18
#: Fingerprints of 64 bits meet within so many, as in op5_simhash.
RADIUS = 2
#: Buckets of up to so many members are compared pair by pair, all of a size at once.
SMALL = 16
#: Counters of one byte hold so many shingles.
COUNTED = 255
#: Buckets of more members are not compared with others for equal members.
COMPARED = 1 << 16
#: Buckets and clusters are taken whole.
WHOLE = 1 << 62


def salts(width: int) -> np.ndarray:
    return mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(PRIME))


def hashed(text: bytes, words: int) -> np.ndarray:
    """Hashes of all shingles, repeats too."""
    found = text.lower().split()
    size = min(words, len(found))
    if not size:
        return np.zeros(0, np.uint64)
    rows = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(s, seed=42) for s in rows), np.uint64, len(found) - size + 1)


def majority(hashes: np.ndarray, width: int) -> bytes:
    ones, salt = np.zeros(BITS * width, np.int64), salts(width)
    for a in range(0, len(hashes), SHINGLES_AT_ONCE):
        bits = np.unpackbits(mix(hashes[a : a + SHINGLES_AT_ONCE, None] ^ salt).view(np.uint8), axis=1, bitorder="little")
        for b in range(0, len(bits), COUNTED):
            ones += bits[b : b + COUNTED].sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes()


def wide_fingerprint(text: bytes, words: int = WORDS, width: int = WIDTH) -> bytes:
    """Of all shingles, repeats too; the operator's own are of distinct ones."""
    return majority(hashed(text, words), width)


def set_digest(distinct: np.ndarray) -> bytes:
    return np.array([mix(distinct ^ salt).sum(dtype=np.uint64) for salt in salts(2)], np.uint64).tobytes()


def rarity(docs: DataFrame, text_column: str, words: int) -> np.ndarray:
    """A level of each counter of hashed shingles, on a log scale: any order serves, one by rarity serves best."""

    def count(texts: list[str | None]) -> np.ndarray:
        forget_models()
        total = np.zeros(COUNTERS, np.int32)
        for a in range(0, len(texts), DOCUMENTS_AT_ONCE):
            found = [np.unique(hashed((t or "").encode(), words)) for t in texts[a : a + DOCUMENTS_AT_ONCE]]
            total += np.bincount((np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS).astype(np.int32)
        return total

    return np.round(np.log2(summed(docs, text_column, count, (COUNTERS,), "int32") + 1.0) * 8).astype(np.uint8)


def rarest(distinct: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of which a similar set has one among its own."""
    n = len(distinct)
    if not n:
        return distinct
    most = n - math.ceil(similarity * n - 1e-9) + 1
    return distinct[np.lexsort((distinct, levels[(distinct % np.uint64(COUNTERS)).astype(np.int64)]))[:most]]


def fingerprints(docs: DataFrame, id_column: str, text_column: str, words: int, width: int, similarity: float, levels: np.ndarray) -> DataFrame:
    """(id, body, same, n, print, fp, rare): md5 of the text, digest and size of the set of shingles, its fingerprint of 64 bits and the wide one that begins with it, and its rarest shingles, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_models()
        for batch in batches:
            sets = [np.unique(hashed(t, words)) for t in binary_rows(batch.column(1))]
            values = [[f(x) for x in sets] for f in (set_digest, lambda x: majority(x, width), lambda x: rarest(x, levels, similarity).tobytes())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values[0], pa.binary()), pa.array([len(x) for x in sets], pa.int32()), pa.array([int.from_bytes(x[: BITS // 8], "little", signed=True) for x in values[1]], pa.int64()), pa.array(values[1], pa.binary()), pa.array(values[2], pa.binary())], ["id", "body", "same", "n", "print", "fp", "rare"])
        trim()

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("t"), body_of(F.col(text_column)).alias("body")).mapInArrow(run, "id long, body binary, same binary, n int, print long, fp binary, rare binary")


def body_of(text: Column) -> Column:
    """What tells texts under one id apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def words_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(binary_rows(column)), np.uint64).reshape(-1, width)


def bucketed(classes: DataFrame) -> DataFrame:
    """classes(first, rare) -> (k, first): a row for each of the rarest shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
                part = batch.slice(a, DOCUMENTS_AT_ONCE)
                blobs = binary_rows(part.column(1))
                first = np.repeat(part.column(0).to_numpy(), [len(x) // 8 for x in blobs])
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(blobs), np.int64)), pa.array(first)], ["k", "first"])

    return classes.select("first", "rare").mapInArrow(run, "k long, first long")


def runs(batches: Iterator[pa.RecordBatch], at_most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """Batches of sorted rows (k, ...) as (rows, where each bucket begins, whether the last goes on).

    Buckets are whole, but for those of over at_most rows: these come in slices.
    """
    held: list[pa.RecordBatch] = []
    rest = 0
    for batch in chain_end(batches):
        if batch is not None:
            held.append(batch)
            rest += batch.num_rows
            k = batch.column(0).to_numpy()
            if not len(k) or (k[0] == k[-1] and rest <= at_most):
                continue  # perhaps one bucket still
        if not rest:
            continue
        rows = pa.concat_batches(held)
        k = rows.column(0).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
        if batch is None:
            yield rows, starts, False
            held, rest = [], 0
        elif len(starts) > 1:
            yield rows.slice(0, int(starts[-1])), starts[:-1], False
            held = [rows.slice(int(starts[-1]))]
            rest = held[0].num_rows
        else:
            yield rows, starts, True
            held, rest = [], 0


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """(k, first) of buckets with several members; of buckets with equal members, one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key = None  # of a bucket that came in slices
        for rows, starts, goes_on in runs(batches, COMPARED):
            k, first = (rows.column(i).to_numpy() for i in (0, 1))
            size = np.diff(np.append(starts, len(k)))
            names = np.add.reduceat(mix(first.view(np.uint64)), starts).view(np.int64)
            sliced = k[starts] == open_key if open_key is not None else np.zeros(len(starts), bool)
            sliced[-1] |= goes_on
            names = np.where(sliced, k[starts], names)
            open_key = k[-1] if goes_on else None
            keep = np.repeat((size > 1) | sliced, size)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, size)[keep]), pa.array(first[keep])], ["k", "first"])

    return keyed.repartition("k").sortWithinPartitions("k").mapInArrow(run, "k long, first long").distinct()


def farthest(similarity: float, width: int) -> int:
    """Differing bits beyond which a pair hardly is this similar."""
    share, n = math.acos(2 * similarity / (1 + similarity)) / math.pi, BITS * width
    return int(share * n + HOPELESS * math.sqrt(share * (1 - share) * n))


def alike(own: np.ndarray, n: np.ndarray, fp: np.ndarray, size: np.ndarray, similarity: float, most: int) -> np.ndarray:
    """Which of several documents may be this similar to one, or each to its own."""
    small, large = np.minimum(n, size), np.maximum(n, size)
    near = small >= similarity * large - 1e-9
    near &= (small < FEW) | (np.bitwise_count(own ^ fp).sum(axis=1, dtype=np.int64) <= most)
    return near


def spread(m: int, meets) -> Iterator[tuple[int, np.ndarray]]:
    """(a member, those that it brings into its group) until all of 0 to m - 1 have met; meets(i, others) tells which join i."""
    rest = np.arange(m)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            hit = meets(i, rest)
            if hit.any():
                yield i, rest[hit]
                front += rest[hit].tolist()
                rest = rest[~hit]


def met_links(members: DataFrame, similarity: float, width: int) -> DataFrame:
    """members(k, first, n, fp) -> (a, b): of each bucket links that connect those that may be similar, one a member at most."""
    most = farthest(similarity, width)

    def of_small(ids: np.ndarray, n: np.ndarray, fps: np.ndarray, starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Of all buckets of one size, pair after pair; a pair that is connected already gives no link."""
        at = starts[:, None] + np.arange(size)
        x, y = (at[:, i] for i in np.triu_indices(size, 1))
        near = alike(fps[x.ravel()], n[x.ravel()], fps[y.ravel()], n[y.ravel()], similarity, most).reshape(x.shape)
        part = np.tile(np.arange(size), (len(starts), 1))
        for i, j, hit in zip(*np.triu_indices(size, 1), near.T, strict=True):
            fresh = np.flatnonzero(hit & (part[:, i] != part[:, j]))
            if len(fresh):
                yield np.stack([ids[at[fresh, i]], ids[at[fresh, j]]])
                old, new = np.maximum(part[fresh, i], part[fresh, j]), np.minimum(part[fresh, i], part[fresh, j])
                part[fresh] = np.where(part[fresh] == old[:, None], new[:, None], part[fresh])

    def of_large(ids: np.ndarray, n: np.ndarray, fps: np.ndarray) -> Iterator[np.ndarray]:
        for i, others in spread(len(ids), lambda i, rest: alike(fps[rest], n[rest], fps[i], n[i], similarity, most)):
            yield np.stack([np.full(len(others), ids[i]), ids[others]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, _ in runs(batches, WHOLE):
            ids, n, fps = rows.column(1).to_numpy(), rows.column(2).to_numpy(), words_of(rows.column(3), width)
            size, found = np.diff(np.append(starts, len(ids))), []
            for m in np.unique(size[(size > 1) & (size <= SMALL)]).tolist():
                found += of_small(ids, n, fps, starts[size == m], m)
            for a, m in zip(starts[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
                found += of_large(ids[a : a + m], n[a : a + m], fps[a : a + m])
            if found:
                links = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["a", "b"])
        trim()

    return members.select("k", "first", "n", "fp").repartition("k").sortWithinPartitions("k", "first").mapInArrow(run, "a long, b long").distinct()


def print_links(classes: DataFrame) -> DataFrame:
    """classes(first, print) -> (a, b): links that connect all whose fingerprints lie within RADIUS bits, by operator 5's covering masks."""
    least = written(classes.groupBy("print").agg(F.min("first").alias("first")).withColumnRenamed("print", "fp"), "prints")
    across = fingerprint_links(least, RADIUS).join(least.toDF("x", "a"), "x").join(least.toDF("y", "b"), "y").select("a", "b")
    return across.unionByName(classes.select("print", F.col("first").alias("b")).join(least.toDF("print", "a"), "print").where("a != b").select("a", "b"))


def shingles(text: bytes, words: int) -> set[bytes]:
    found = text.lower().split()
    size = min(words, len(found))
    return set(map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False)))


def group_of(texts: list[bytes], n: np.ndarray, fps: np.ndarray, words: int, similarity: float, most: int) -> np.ndarray:
    """Place of the first member of each one's group: groups are connected by pairs of this similarity or more."""
    sets = [np.unique(hashed(t, words)) for t in texts]
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes.astype(np.int32), np.cumsum([len(x) for x in sets])[:-1])
    there, group = np.zeros(len(names), bool), np.arange(len(texts))

    def meets(i: int, rest: np.ndarray) -> np.ndarray:
        near = alike(fps[rest], n[rest], fps[i], n[i], similarity, most)
        at = np.flatnonzero(near)
        if not len(at):
            return near
        sizes = n[rest[at]].astype(np.int64)
        there[codes[i]] = True
        both = np.add.reduceat(there[np.concatenate([codes[j] for j in rest[at].tolist()])], np.cumsum(sizes) - sizes, dtype=np.int64)
        there[codes[i]] = False
        likely = both >= similarity * (n[i] + sizes - both) - 1e-9
        near[at[~likely]] = False
        own = shingles(texts[i], words) if likely.any() else set()
        for j in at[likely].tolist():
            other = shingles(texts[int(rest[j])], words)
            near[j] = len(own & other) >= similarity * len(own | other)
        return near

    for i, others in spread(len(texts), meets):
        group[others] = group[i]
    return group


def groups(members: DataFrame, words: int, width: int, similarity: float) -> DataFrame:
    """members(cluster, first, n, fp, t) -> (first, component): the first of its group, for members of a cluster."""
    most = farthest(similarity, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, _ in runs(batches, WHOLE):
            ids, n, fps = rows.column(1).to_numpy(), rows.column(2).to_numpy(), words_of(rows.column(3), width)
            found = []
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(ids)).tolist(), strict=True):
                found.append(ids[a + group_of(binary_rows(rows.column(4).slice(a, b - a)), n[a:b], fps[a:b], words, similarity, most)])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(found))], ["first", "component"])
        trim()

    return members.select("cluster", "first", "n", "fp", "t").repartition("cluster").sortWithinPartitions("cluster", "first").mapInArrow(run, "first long, component long")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """(id, body, group, stays) of each row: the smallest id reachable over links of documents this similar or more, and whether its text is the one that stays."""
    levels = rarity(docs, text_column, words)
    every = written(fingerprints(docs, id_column, text_column, words, width, similarity, levels), "wide")
    least = every.where("id is not null").groupBy("same").agg(F.min(F.struct("id", "body", "n", "print", "fp", "rare")).alias("m"))
    classes = written(least.select("same", F.monotonically_increasing_id().alias("first"), "m.id", "m.body", "m.n", "m.print", "m.fp", "m.rare"), "classes")
    known = classes.select("first", "n", "fp")
    met = met_links(shared_buckets(bucketed(classes)).join(known, "first"), similarity, width)
    clusters = written(components(met.unionByName(print_links(classes.where("n > 0")))).toDF("first", "cluster"), "clusters")

    wanted = classes.select("first", "id", "body", "n", "fp").join(clusters, "first")
    bodies = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("t")).withColumn("body", body_of(F.col("t")))
    joined = groups(bodies.join(wanted, ["id", "body"]).dropDuplicates(["first"]), words, width, similarity)
    placed = classes.select("same", "first", "id", "body").join(joined, "first", "left").withColumn("component", F.coalesce("component", "first"))
    best = placed.groupBy("component").agg(F.min(F.struct("id", "body")).alias("best"))
    found = placed.join(best, "component").select("same", "best")
    rows = every.select("id", "body", "same").join(found, "same", "left")
    known = F.col("id").isNotNull()
    stays = ~known | ((F.col("id") == F.col("best.id")) & (F.col("body") == F.col("best.body")))
    return rows.select("id", "body", F.when(known, F.col("best.id")).alias("group"), stays.alias("stays"))
