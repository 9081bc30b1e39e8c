"""Operator 3: packing token sequences, best fit first and then swap-based local search.

Documents are tokenised where they lie; only piece lengths are dealt, by a hash of their
place, into shards of about `shard` pieces. A shard is packed best-fit decreasing. Then
bins with room left are searched: pieces of the least filled bin move to others, or are
exchanged one for one or two for one, whenever that raises the sum of squared fills, until
the bin is empty or nothing helps. Partners are found through bit sets of lengths by room.
The search ends at a lower bound of bins, or after a stated number of look-ups.

Defined results: null text is empty text and gives one piece of the end token; documents
longer than the capacity are cut into full pieces, the first piece takes the remainder;
repeated rows are packed as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chartloom.llm.common import giving_way, parts_for, positional, written

CAPACITY, SHARD, END = 2048, 50_000, 0
#: Look-ups of the local search in a shard, at most.
EFFORT = 2_000_000


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def fast_reader(path: str) -> tuple[tiktoken.Encoding, list[str]]:
    """A faster reader of a byte-level BPE file, for text without its special tokens, and these."""
    import public_tokenizers

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = [t["content"] for t in told["added_tokens"]]
    ranks = {bytes(byte[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), special


def token_ids(text: str, path: str) -> np.ndarray:
    fast, special = fast_reader(path)
    if any(s in text for s in special):
        return np.array(tokenizer_of(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(fast.encode_ordinary(text), np.uint32)


def pieces_of(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length): only the first may be shorter."""
    first = len(ids) % capacity or capacity
    start, piece = 0, 0
    while start < len(ids):
        length = first if not piece else capacity
        yield piece, start, length
        start, piece = start + length, piece + 1


def tokenised(docs: DataFrame, id_column: str, text_column: str, path: str, capacity: int) -> DataFrame:
    """A row for each piece: the other columns, piece, start, length, ids_crc32."""
    plain, names = positional(giving_way(docs, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
    at = names.index(text_column)
    kept = [f for i, f in enumerate(plain.schema.fields) if i != at]
    fields = "piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows = [], []
            for i, text in enumerate(batch.column(at).to_pylist()):
                ids = np.append(token_ids(text or "", path), np.uint32(END))
                for piece, start, length in pieces_of(ids, capacity):
                    of.append(i)
                    rows.append((piece, start, length, zlib.crc32(ids[start : start + length].astype("<u4").tobytes())))
            taken = batch.drop_columns([batch.schema.names[at]]).take(pa.array(of, pa.int64()))
            found = zip(*rows, strict=True) if rows else ([], [], [], [])
            columns = [pa.array(x, t) for x, t in zip(found, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*taken.columns, *columns], [*taken.schema.names, "piece", "start", "length", "ids_crc32"])

    from pyspark.sql.types import StructType

    out = plain.mapInArrow(run, StructType(kept + StructType.fromDDL(fields).fields))
    return out.toDF(*[n for i, n in enumerate(names) if i != at], "piece", "start", "length", "ids_crc32")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins of indices. Bins of one room are alike, so a bit set of rooms finds the tightest."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        left = room - size
        by_room[left].append(b)
        rooms |= 1 << left
    return bins


def fewest(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of bins: for each t up to half the capacity, pieces over capacity - t stand alone,
    others over half do too, and what pieces from t on exceed the room beside those needs bins of its own."""
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    n, total = np.cumsum(count[::-1])[::-1], np.cumsum((count * np.arange(capacity + 1))[::-1])[::-1]
    n, total = np.append(n, [0, 0]), np.append(total, [0, 0])  # of pieces of this length and more
    t, half = np.arange(capacity // 2 + 1), capacity // 2 + 1
    alone, above = n[capacity - t + 1], n[half]
    beside = (above - alone) * capacity - (total[half] - total[capacity - t + 1])  # room beside pieces of half to capacity - t
    rest = np.maximum(0, total[t] - total[half] - beside)
    return int(np.max(above + -(-rest // capacity), initial=0))


class Bins:
    """Bins by room, and under each room the lengths of their pieces as a bit set: partners are looked up, not tried."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int) -> None:
        self.size, self.capacity = lengths.tolist(), capacity
        self.pieces: list[dict[int, list[int]]] = []  # of each bin: length -> pieces
        self.fill: list[int] = []
        self.rooms = 0  # bit set of the rooms of bins that are neither empty nor full
        self.held: dict[int, dict[int, set[int]]] = {}  # room -> length -> bins
        self.lengths: dict[int, int] = {}  # room -> bit set of lengths
        for members in bins:
            own: dict[int, list[int]] = {}
            for i in members:
                own.setdefault(self.size[i], []).append(i)
            self.pieces.append(own)
            self.fill.append(sum(self.size[i] for i in members))
            self.enter(len(self.fill) - 1)
        self.heap = [(f, b) for b, f in enumerate(self.fill) if f < capacity]
        heapify(self.heap)

    def enter(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if room and self.pieces[b]:
            self.rooms |= 1 << room
            held = self.held.setdefault(room, {})
            for length in self.pieces[b]:
                held.setdefault(length, set()).add(b)
                self.lengths[room] = self.lengths.get(room, 0) | 1 << length

    def leave(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        held = self.held.get(room, {})
        for length in self.pieces[b]:
            if b in held.get(length, ()):
                held[length].discard(b)
                if not held[length]:
                    del held[length]
                    self.lengths[room] &= ~(1 << length)
        if room in self.held and not held:
            del self.held[room], self.lengths[room]
            self.rooms &= ~(1 << room)

    def move(self, source: int, target: int, give: tuple[int, ...], take: tuple[int, ...] = ()) -> None:
        """Pieces of these lengths change places."""
        for b in (source, target):
            self.leave(b)
        for a, b, lengths in ((source, target, give), (target, source, take)):
            for length in lengths:
                own = self.pieces[a][length]
                self.pieces[b].setdefault(length, []).append(own.pop())
                if not own:
                    del self.pieces[a][length]
                self.fill[a] -= length
                self.fill[b] += length
        for b in (source, target):
            self.enter(b)
        if self.fill[target] < self.capacity:
            heappush(self.heap, (self.fill[target], target))

    def other(self, bins: set[int], source: int) -> int | None:
        return next((b for b in islice(bins, 2) if b != source), None)

    def step(self, source: int) -> tuple[bool, int]:
        """One move, one-for-one or two-for-one exchange out of the source that raises the sum of squared fills; and the look-ups made."""
        own, fill, tried = sorted(self.pieces[source], reverse=True), self.fill[source], 0
        for length in own:  # the tightest room, as far as its bin ends up above what the source was
            above = self.rooms >> length
            while above:
                tried += 1
                room = length + (above & -above).bit_length() - 1
                if self.capacity - room + length <= fill:
                    break
                target = next((b for bins in self.held[room].values() if (b := self.other(bins, source)) is not None), None)
                if target is not None:
                    self.move(source, target, (length,))
                    return True, tried
                above &= above - 1
        gifts = {length: (length,) for length in own}
        for i, x in enumerate(own):
            for y in own[i:]:
                if x != y or len(self.pieces[source][x]) > 1:
                    gifts.setdefault(x + y, (x, y))
        for room in sorted(self.held):  # full bins first
            known, short = self.lengths[room], max(1, fill - (self.capacity - room) + 1)
            for total, give in gifts.items():  # the target gains total - t, from `short` to `room`
                tried += 1
                least = max(0, total - room)
                fit = (known & ((1 << max(0, total - short + 1)) - 1)) >> least
                while fit:
                    length = least + (fit & -fit).bit_length() - 1
                    target = self.other(self.held[room][length], source)
                    if target is not None:
                        self.move(source, target, give, (length,))
                        return True, tried
                    fit &= fit - 1
        return False, tried


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, effort: int = EFFORT) -> list[list[int]]:
    """Empty the least filled bins by moves and exchanges that raise the sum of squared fills.

    Ends when the lower bound is met, when no bin has anything to gain, or after `effort`
    look-ups: the packing is whole at any time.
    """
    bound = fewest(lengths, capacity)
    alive = len(bins)
    if alive <= bound:
        return bins
    state = Bins(bins, lengths, capacity)
    while alive > bound and state.heap and effort > 0:
        fill, source = heappop(state.heap)
        if fill != state.fill[source]:
            continue  # it changed since
        while state.pieces[source]:
            went, tried = state.step(source)
            effort -= tried
            if not went or effort <= 0:
                break
        alive -= not state.pieces[source]
    return [[i for own in b.values() for i in own] for b in state.pieces if b]


def packed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    which, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for n, members in enumerate(bins):
        which[members] = n
        offset[members] = np.concatenate([[0], np.cumsum(lengths[members])[:-1]])
    return which, offset


def best_fit_pack(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, shard: int = SHARD, tokenizer: str | None = None) -> DataFrame:
    """A row for each piece: the other columns, piece, start, length, ids_crc32, sequence_id and offset."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    plain, names = positional(tokenised(docs, id_column, text_column, tokenizer, capacity))
    plain = written(plain, "pieces")
    shards = parts_for(plain.count(), shard)
    at = {c: f"_c{names.index(c)}" for c in ("piece", "start", "length", "ids_crc32")}
    place = F.xxhash64(F.monotonically_increasing_id(), at["ids_crc32"])  # rows of one id or text spread; a written table's rows keep their places
    dealt = plain.withColumn("shard", F.pmod(place, F.lit(shards)))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([at["length"], at["ids_crc32"], at["start"]], kind="stable")
        which, offset = packed(pdf[at["length"]].to_numpy(), capacity)
        return pdf.assign(sequence_id=which * shards + pdf["shard"].to_numpy(), offset=offset).drop(columns="shard")

    from pyspark.sql.types import StructType

    schema = StructType(plain.schema.fields + StructType.fromDDL("sequence_id long, offset long").fields)
    return dealt.groupBy("shard").applyInPandas(pack, schema).toDF(*names, "sequence_id", "offset")

