"""Operator 4: repeated word windows, found by backward search in one FM-index per shard.

A shard's distinct records become one text over word numbers; its Burrows-Wheeler
transform sits in a wavelet matrix of packed bits with rank directories. Records are
streamed through it from the right: each step narrows the suffix interval by one word
and lengthens the match; where the match reaches `length` words the interval lies in
one block of suffixes that share those words, whose smallest document decides.

Defined results: null text has no words; a null id counts as larger than any other;
rows of one id do not remove each other's words; an empty table gives an empty result;
other columns pass
through, those named like a result give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.repeats import Chunk, remove_repeats, word_units


class BitVector:
    """Packed bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Rank of any symbol in a sequence, a bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.levels: list[tuple[int, BitVector, int]] = []
        row = symbols
        for shift in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            bit = (row >> shift) & 1 == 1
            self.levels.append((shift, BitVector(bit), int(len(bit) - bit.sum())))
            row = np.concatenate([row[~bit], row[bit]])
        self.start = self.descend(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> shift) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.descend(symbol, i) - self.start[symbol]


class FMIndex:
    """Over records of word numbers (from 0); symbol 0 ends each record."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, alphabet: int) -> None:
        records = len(sizes)
        stop = np.cumsum(sizes + 1) - 1  # where each record's end symbol stands
        text = np.zeros(len(words) + records, np.int64)
        body = np.ones(len(text), bool)
        body[stop] = False
        text[body] = words + 1
        rank = np.empty(len(text), np.int64)
        rank[stop] = np.arange(records)  # end symbols differ, so no suffix order reaches past its record
        rank[body] = words + records
        self.depth8, depth = None, 1
        order = np.argsort(rank, kind="stable")
        rank, active = self.buckets(rank[order], order, len(text))
        longest = int(sizes.max(initial=0)) + 1
        while len(active) and depth < longest:
            further = np.minimum(active + depth, len(text) - 1)
            key = (rank[active].astype(np.uint64) << np.uint64(32)) | rank[further].astype(np.uint64)
            by = np.argsort(key, kind="stable")
            key, active = key[by], active[by]
            i = np.arange(len(key))
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            outer = np.concatenate([[True], (key[1:] >> np.uint64(32)) != (key[:-1] >> np.uint64(32))])
            rank[active] += np.maximum.accumulate(np.where(fresh, i, 0)) - np.maximum.accumulate(np.where(outer, i, 0))
            active = active[~fresh | np.append(~fresh[1:], False)]
            depth *= 2
            if depth == 8:
                self.depth8 = rank.copy()
        self.suffix = np.empty(len(text), np.int64)
        self.suffix[rank] = np.arange(len(text))
        self.rank = rank
        self.text, self.stop, self.alphabet = text, stop, alphabet + 1
        before = text[self.suffix - 1]
        before[self.suffix == 0] = 0
        self.tree = WaveletMatrix(before, self.alphabet)
        self.least = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.alphabet))])

    @staticmethod
    def buckets(key: np.ndarray, order: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        rank = np.empty(n, np.int64)
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        return rank, order[~fresh | np.append(~fresh[1:], False)]

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the interval of `word` followed by what low..high stands for."""
        symbol = word + 1
        return self.least[symbol] + self.tree.rank(symbol, low), self.least[symbol] + self.tree.rank(symbol, high)

    def count(self, pattern: list[int]) -> int:
        low, high = np.array([0]), np.array([len(self.text)])
        for word in reversed(pattern):
            low, high = self.extend(np.array([word]), low, high)
        return int((high - low)[0])

    def blocks(self, length: int) -> np.ndarray:
        """For each place in suffix order, the number of its run of suffixes with equal first `length` words."""
        s, n = self.suffix, len(self.text)
        if length >= 8 and self.depth8 is not None and length <= 16:
            whole, later = self.depth8[s], self.depth8[np.minimum(s + length - 8, n - 1)]
            new = (whole[1:] != whole[:-1]) | (later[1:] != later[:-1])
        else:
            new = np.zeros(n - 1, bool)
            for i in range(length):
                t = self.text[np.minimum(s + i, n - 1)]
                new |= (t[1:] != t[:-1]) | (t[1:] == 0)
        return np.concatenate([[0], np.cumsum(new)])


def match_words(texts: list[bytes], docs: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Bits of the windows of each record that start in a record of a smaller document."""
    distinct: dict[bytes, int] = {}
    of = np.array([distinct.setdefault(t, len(distinct)) for t in texts], np.int64)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, of, docs)
    windows = np.zeros(len(distinct), np.int64)
    windows[of] = counts
    coded = pa.array(b" ".join(distinct).split(), pa.binary()).dictionary_encode()
    words, sizes = coded.indices.to_numpy().astype(np.int64), windows + length - 1
    index = FMIndex(words, sizes, len(coded.dictionary))
    block = index.blocks(length)
    owner = np.minimum(np.searchsorted(index.stop, index.suffix), len(sizes) - 1)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    smallest = np.minimum.reduceat(least[owner], first)
    mask = np.zeros(len(distinct), np.uint64)
    live = np.arange(len(distinct))
    low, high = np.zeros(len(live), np.int64), np.full(len(live), len(index.text))
    for step in range(int(sizes.max())):  # all records at once, from their last words on
        on = sizes[live] > step
        live, low, high = live[on], low[on], high[on]
        at = index.stop[live] - 1 - step
        low, high = index.extend(index.text[at] - 1, low, high)
        if step + 1 >= length:
            hit = (high > low) & (smallest[block[low]] < least[live])
            place = at - (index.stop[live] - sizes[live])
            mask[live[hit]] |= np.uint64(1) << place[hit].astype(np.uint64)
    full = (np.uint64(1) << counts.astype(np.uint64)) - np.uint64(1)
    return np.where(docs > least[of], full, mask[of])


def finish_words(chunk: Chunk, removed: np.ndarray):
    first = chunk.seq.first.tolist()
    for i, text in enumerate(chunk.texts):
        words, flags = text.split(), removed[first[i] : first[i + 1]]
        kept = [w for w, gone in zip(words, flags.tolist(), strict=True) if not gone] if flags.any() else words
        edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).tolist()
        yield len(words), [{"start": a, "length": b - a} for a, b in zip(edge[0::2], edge[1::2], strict=True)], b" ".join(kept)


def fm_index_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 13, gram: int = 5) -> DataFrame:
    """docs plus n_words, word_spans (removed runs of words) and kept (the words left, joined by one space, as bytes)."""
    fields = "n_words long, word_spans array<struct<start: long, length: long>>, kept binary"
    return remove_repeats(docs, id_column, text_column, word_units, length, gram, match_words, finish_words, fields)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """The digest in DuckDB SQL: every window of 13 words with the least document it starts in."""
    return r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t)),
l AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g HAVING count(*) > 1),
b AS (SELECT s.doc_id, s.i FROM s JOIN l USING (g) WHERE l.least < s.doc_id),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
c AS (SELECT p.doc_id, p.i, p.word, count(b.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) > 0 AS gone FROM p LEFT JOIN b ON p.doc_id = b.doc_id AND p.i = b.i),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(a.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(a.kept, '')) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id)
"""
