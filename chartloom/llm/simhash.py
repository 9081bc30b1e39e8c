"""Operator 5: SimHash near-duplicates through covering locality-sensitive hashing.

Each of the 64 bit places gets a label of r + 1 bits. For every non-zero vector v of
r + 1 bits, the mask of v keeps the places whose label has an odd number of bits in
common with v. The labels of any r places span at most r dimensions, so some v is
orthogonal to all of them and its mask keeps none of the r: fingerprints within r bits
agree under one of the 2**(r+1) - 1 masks.

Fingerprints are made distinct first: a group of copies is one fingerprint, however
large. A bucket's links are found by looking up each fingerprint's neighbours under the
places that the mask does not keep, and leave as a spanning forest. Buckets above
`bucket` fingerprints are first split by a second family of masks, with other labels.

Defined results: null or empty text and text without words has fingerprint zero; fewer
words than a shingle give one shingle of all words; an empty table gives an empty
result; repeated rows get equal results; rows with a null id are fingerprinted and stand
alone (null component).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import binary_rows, written
from chartloom.llm.graph import components

BITS = 64
#: Fingerprints in a bucket beyond which it is split by the second family of masks.
BUCKET = 4096
SHINGLES_AT_ONCE = 1 << 14


def covering_masks(radius: int, family: int = 0) -> list[int]:
    """The 2**(radius+1) - 1 masks. Labels run through all non-zero values in turn, in another order in each family."""
    labels = (1 << (radius + 1)) - 1
    label = [1 + (i * (family + 1) + i // labels * family) % labels for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (label[i] & v).bit_count() % 2) for v in range(1, labels + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, words: int) -> int:
    found = text.lower().split()
    if not found:
        return 0
    h = partial(xxhash.xxh64_intdigest, seed=42)
    if len(found) < words:
        return h(b" ".join(found))
    parts = [found[i:] for i in range(words)]
    n, ones = len(found) - words + 1, np.zeros(BITS, np.int64)
    shingles = map(b" ".join, zip(*parts, strict=False))
    for a in range(0, n, SHINGLES_AT_ONCE):
        count = min(SHINGLES_AT_ONCE, n - a)
        hashes = np.fromiter((h(s) for _, s in zip(range(count), shingles, strict=False)), np.uint64, count)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [signed(fingerprint(t, words)) for t in binary_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["id", "fp"])

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("t"))
    return plain.mapInArrow(run, "id long, fp long")


def linked(members: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between sorted distinct fingerprints of one bucket."""
    n = len(members)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if n <= 512:
            for i in range(n - 1):
                near = np.flatnonzero(np.bitwise_count(members[i + 1 :] ^ members[i]) <= radius) + i + 1
                yield np.full(len(near), i), near
            return
        free = np.bitwise_or.reduce(members ^ members[0])  # places where members differ at all
        places = [i for i in range(BITS) if int(free) >> i & 1]
        for k in range(1, radius + 1):
            for flip in combinations(places, k):
                other = members ^ np.uint64(sum(1 << i for i in flip))
                at = np.minimum(np.searchsorted(members, other), n - 1)
                hit = np.flatnonzero((members[at] == other) & (at > np.arange(n)))
                yield hit, at[hit]

    for left, right in pairs():
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield int(members[i]), int(members[j])


def bucket_links(keyed: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links inside buckets; rows of a bucket are neighbours in a sorted partition and stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in chain_end(batches):
            if batch is not None:
                held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys) + 1)]))
            rows = np.concatenate(held, axis=1) if held else np.zeros((len(keys) + 1, 0), np.int64)
            if not rows.shape[1]:
                continue
            cut = np.flatnonzero((rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0)) + 1
            ends = np.append(cut, rows.shape[1])
            whole = ends if batch is None else ends[:-1]  # the last bucket may go on
            starts = np.concatenate([[0], cut])[: len(whole)]
            several = np.flatnonzero(whole - starts > 1)
            found = [e for i in several for e in linked(np.unique(rows[-1, starts[i] : whole[i]].view(np.uint64)), radius)]
            held = [] if batch is None else [rows[:, ends[-2] if len(ends) > 1 else 0 :]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([signed(x[i]) for x in found], pa.int64()) for i in (0, 1)], ["x", "y"])

    return keyed.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(run, "x long, y long")


def chain_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def masked(df: DataFrame, masks: list[int], name: str) -> DataFrame:
    """A row for each mask: which one, and the fingerprint under it."""
    each = F.array(*[F.struct(F.lit(i).cast("long").alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for i, m in enumerate(masks)])
    return df.select("*", F.explode(each).alias("m")).select(*df.columns, F.col("m.v").alias(f"v{name}"), F.col("m.k").alias(f"k{name}"))


def fingerprint_links(distinct: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """(x, y) of distinct fingerprints: as many links as connect all that lie within `radius` bits."""
    keyed = masked(distinct.select("fp"), covering_masks(radius), "1")
    hot = written(keyed.groupBy("v1", "k1").count().where(F.col("count") > bucket).select("v1", "k1"), "hot")
    if hot.isEmpty():
        return bucket_links(keyed, ["v1", "k1"], radius)
    small = bucket_links(keyed.join(hot, ["v1", "k1"], "left_anti"), ["v1", "k1"], radius)
    split = masked(keyed.join(hot, ["v1", "k1"]), covering_masks(radius, family=1), "2")
    return small.unionByName(bucket_links(split, ["v1", "k1", "v2", "k2"], radius))


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component): the smallest id reachable over links of at most `radius` differing bits."""
    every = written(fingerprints(docs, id_column, text_column, words), "fingerprints")
    classes = written(every.where("id is not null").groupBy("fp").agg(F.min("id").alias("first")), "classes")
    first = classes.select("fp", "first")
    edges = fingerprint_links(classes, radius).join(first.toDF("x", "a"), "x").join(first.toDF("y", "b"), "y").select("a", "b")
    joined = components(edges)
    found = classes.join(joined.withColumnRenamed("node", "first"), "first", "left").select("fp", F.coalesce("component", "first").alias("component"))
    return every.join(found, "fp", "left").select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
