"""Operator 9: chroma audio fingerprints of a media column, and the alignment of recordings.

A recording is mono samples. Frames become twelve pitch-class energies; an integral image
over them gives any rectangle's sum at once; sixteen rectangle filters, each quantised to
two Gray-coded bits, make a 32-bit integer per frame. Recordings with equal integer
sequences are one class. Query recordings (ids divisible by `every`) meet all classes: an
integer counts as a hit where any one of its four `PARTS` of 16 bits is the same, which
survives bit errors that no whole integer does. Every offset with `hits` hits, and `SHARE` of
its overlap, is tested by
the bit error rate over its overlap; of the offsets that stand, the one of most hits is
reported. Queries go round in groups of at most `GROUP` integers and are looked up while
the classes stream by, so chance hits are counted in place and never become rows.

Defined results: null media, NaN samples and recordings too short for one integer have no
prints, a class of their own and no matches; a null id gets a null class; equal recordings
share the class of the smallest id; an empty table gives an empty result; repeated rows get
equal results. `links` and `matches` are null for recordings that are not queries.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import parts_for, written

RATE, FRAME, HOP = 4000, 256, 128
LOWEST, CLASSES, WIDTH = 110.0, 12, 16
#: Steps between the four levels of a filter.
LEVELS = np.array([-0.35, 0.0, 0.35])
HITS, ERRORS, OVERLAP, EVERY = 2, 0.15, 24, 50
#: The 16 bits of each part of an integer: low, high, inner and outer.
PARTS = (0x0000FFFF, 0xFFFF0000, 0x00FFFF00, 0xFF0000FF)
#: Hits for each integer of the overlap below which an offset is not tested; 15 % of independent bit errors leave 0.3.
SHARE = 0.1
#: Integers of queries that are looked up at a time, and hits that are counted at a time.
GROUP, HITS_AT_ONCE = 1 << 18, 1 << 21
NOTE = 256


def filter_bank() -> list[tuple[int, int, int, int]]:
    """Sixteen filters (kind, lowest class, height, width), by a rule: kinds, heights and widths in turn."""
    return [(i % 6, (5 * i) % 9, 2 + i % 3, (4, 8, 12, 16)[(i // 2) % 4]) for i in range(16)]


def chroma(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """(frames, 12) energies of pitch classes, each frame of unit length."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP][:n] * np.hanning(FRAME)
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    tone = np.fft.rfftfreq(FRAME, 1 / rate)
    use = tone >= LOWEST
    pitch = np.round(12 * np.log2(tone[use] / 440)).astype(int) % CLASSES
    out = power[:, use] @ np.eye(CLASSES)[pitch]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def rectangle(image: np.ndarray, t: np.ndarray, y: int, w0: int, w1: int, h0: int, h1: int) -> np.ndarray:
    """Sum over frames t+w0 .. t+w1 and classes y+h0 .. y+h1 (ends excluded) of an integral image."""
    top, low = y + h0, y + h1
    return image[t + w1, low] - image[t + w0, low] - image[t + w1, top] + image[t + w0, top]


def prints(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    energy = chroma(samples, rate)
    count = len(energy) - WIDTH + 1
    if count < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(energy) + 1, CLASSES + 1))
    image[1:, 1:] = energy.cumsum(axis=0).cumsum(axis=1)
    t, out = np.arange(count), np.zeros(count, np.uint32)
    for kind, y, h, w in filter_bank():
        h = min(h, CLASSES - y)
        half, mid, third = w // 2, max(1, h // 2), w // 4
        whole = rectangle(image, t, y, 0, w, 0, h)
        part = {
            0: lambda: whole, 1: lambda: rectangle(image, t, y, 0, w, 0, mid), 2: lambda: rectangle(image, t, y, 0, half, 0, h),
            3: lambda: rectangle(image, t, y, 0, half, 0, mid) + rectangle(image, t, y, half, w, mid, h),  # noqa: B023
            4: lambda: rectangle(image, t, y, 0, w, mid, min(h, mid + 1)), 5: lambda: rectangle(image, t, y, third, w - third, 0, h),  # noqa: B023
        }[kind]()
        rest = rectangle(image, t, 0, 0, w, 0, CLASSES) - whole if kind == 0 else whole - part
        level = np.searchsorted(LEVELS, np.log1p(np.maximum(part, 0)) - np.log1p(np.maximum(rest, 0))).astype(np.uint32)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
    return out


def wav_samples(media: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples of a 16-bit WAV file, and their rate; channels are averaged."""
    if not media:
        return np.zeros(0), RATE
    with wave.open(io.BytesIO(media)) as f:
        data = np.frombuffer(f.readframes(f.getnframes()), "<i2").astype(float)
        return data.reshape(-1, f.getnchannels()).mean(axis=1), f.getframerate()


def melody(vector: list[float] | None) -> tuple[np.ndarray, int]:
    """Samples of a vector played as notes, one for each number: stands in for recordings where a table has none."""
    if vector is None or not len(vector) or any(x is None or not np.isfinite(x) for x in vector):
        return np.zeros(0), RATE
    v = np.asarray(vector, float)
    step = np.round(v / max(np.abs(v).max(), 1e-9) * 11).astype(int) % CLASSES
    phase = 2 * np.pi * np.cumsum(np.repeat(440 * 2 ** (step / 12), NOTE)) / RATE
    return np.sin(phase), RATE


def fingerprints(media: DataFrame, id_column: str, media_column: str, decode: Callable) -> DataFrame:
    """(id, prints): the integers of each recording, in order, as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [prints(*decode(x)).astype("<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "prints"])

    return media.select(F.col(id_column).cast("long").alias("id"), F.col(media_column).alias("media")).mapInArrow(run, "id long, prints binary")


class Queries:
    """Prints of query classes, to be looked up by parts."""

    def __init__(self, ids: list[int], blobs: list[bytes]) -> None:
        self.ids, self.prints = ids, [np.frombuffer(b, "<u4") for b in blobs]
        self.sizes = np.array([len(x) for x in self.prints], np.int64)
        every = np.concatenate(self.prints)
        self.owner = np.repeat(np.arange(len(ids)), self.sizes)
        self.at = np.arange(len(every)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.order = [np.argsort(every & np.uint32(m), kind="stable") for m in PARTS]
        self.sorted = [(every & np.uint32(m))[o] for m, o in zip(PARTS, self.order, strict=True)]

    def offsets(self, x: np.ndarray, hits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, shift, hits) of all offsets of x with enough hits."""
        base = np.concatenate([[0], np.cumsum(self.sizes + len(x))])
        votes = np.zeros(int(base[-1]), np.int64)
        for m, order, known in zip(PARTS, self.order, self.sorted, strict=True):
            value = x & np.uint32(m)
            low, high = np.searchsorted(known, value), np.searchsorted(known, value, side="right")
            chunk = np.cumsum(high - low) // HITS_AT_ONCE
            for a, b in zip(*(np.searchsorted(chunk, np.unique(chunk), side=side) for side in ("left", "right")), strict=True):
                n = (high - low)[a:b]
                hit = order[np.arange(n.sum()) + np.repeat(low[a:b] - (np.cumsum(n) - n), n)]
                q = self.owner[hit]
                np.add.at(votes, base[q] + self.at[hit] - np.repeat(np.arange(a, b), n) + len(x), 1)
        found = np.flatnonzero(votes >= hits)
        q = np.searchsorted(base, found, side="right") - 1
        return q, found - base[q] - len(x), votes[found]


def overlapping(a: np.ndarray, b: np.ndarray, shift: int) -> tuple[int, float]:
    """Length of the overlap where a begins shift integers before b, and the share of differing bits there."""
    x, y = a[max(0, shift) :], b[max(0, -shift) :]
    n = min(len(x), len(y))
    return n, float(np.bitwise_count(x[:n] ^ y[:n]).sum()) / (32 * n) if n else 1.0


def alignments(classes: DataFrame, queries: Queries, hits: int, most_errors: float, least_overlap: int) -> DataFrame:
    """classes(class_id, prints) -> (q, c, shift, errors) of the queries that each class aligns with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for c, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(blob, "<u4")
                q, shift, n = queries.offsets(x, hits)
                room = np.minimum(queries.sizes[q] - np.maximum(shift, 0), len(x) - np.maximum(-shift, 0))
                best: dict[int, tuple[int, int, float]] = {}
                for i in np.flatnonzero((room >= least_overlap) & (n >= (SHARE * room).astype(np.int64))).tolist():
                    j = int(q[i])
                    if queries.ids[j] == c:
                        continue
                    _, errors = overlapping(queries.prints[j], x, int(shift[i]))
                    if errors <= most_errors:
                        best[j] = max(best.get(j, (0, 0, 0.0)), (int(n[i]), -int(shift[i]), errors))
                rows += [(queries.ids[j], c, -s, e) for j, (_, s, e) in best.items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["q", "c", "shift", "errors"])

    return classes.select("class_id", "prints").mapInArrow(run, "q long, c long, shift long, errors double")


def align(media: DataFrame, id_column: str, media_column: str, decode: Callable = wav_samples, every: int = EVERY, hits: int = HITS, most_errors: float = ERRORS, least_overlap: int = OVERLAP) -> DataFrame:
    """id, n_prints, class_id, links and matches (class_id, shift, errors), sorted."""
    every_row = written(fingerprints(media, id_column, media_column, decode), "prints")
    known = every_row.where(F.col("id").isNotNull() & (F.octet_length("prints") > 0))
    classes = written(known.groupBy("prints").agg(F.min("id").alias("class_id"), F.max(F.col("id") % every == 0).alias("asked")), "classes")
    stored = classes.select("class_id", "prints")
    asked = classes.where("asked").select("class_id", "prints")
    groups = parts_for(int(asked.agg(F.sum(F.octet_length("prints") / 4)).first()[0] or 0), GROUP)
    right = media.sparkSession.createDataFrame([], "q long, c long, shift long, errors double")
    for group in range(groups):
        own = asked.where(F.pmod(F.xxhash64("class_id"), F.lit(groups)) == group).orderBy("class_id").collect()
        if own:
            queries = Queries([r["class_id"] for r in own], [bytes(r["prints"]) for r in own])
            right = right.unionByName(alignments(stored, queries, hits, most_errors, least_overlap))
    found = right.groupBy("q").agg(F.array_sort(F.collect_list(F.struct(F.col("c").alias("class_id"), "shift", "errors"))).alias("matches"))
    query = F.col("id") % every == 0
    base = every_row.join(stored, "prints", "left").select("id", (F.octet_length("prints") / 4).cast("long").alias("n_prints"), F.when(F.octet_length("prints") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"))
    base = base.withColumn("class_id", F.when(F.col("id").isNotNull(), F.col("class_id")))
    none = F.array().cast("array<struct<class_id: bigint, shift: bigint, errors: double>>")
    joined = base.join(found.withColumnRenamed("q", "class_id"), "class_id", "left")
    return joined.select("id", "n_prints", "class_id", F.when(query, F.size(F.coalesce("matches", none)).cast("long")).alias("links"), F.when(query, F.coalesce("matches", none)).alias("matches"))
