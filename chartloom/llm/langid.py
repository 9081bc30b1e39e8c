"""Operator 6: language by cross-parsing entropy over suffix automata.

The labelled words of each language become a suffix automaton. A text is parsed against
each automaton, word by word, into the fewest longest matches; phrases are weighted with
the logarithm of the automaton's size, and the language with the smallest total wins.
The words of many texts are parsed together, by a table of the automaton.

The automata are fitted on a bounded sample: of each language the row of smallest hash in
each of `rows` hash buckets, whole; of the distinct words of these the ones that most rows
have, up to `chars` characters. Prediction covers whole texts.

Defined results: null text and text without a letter (Unicode L) give `und` and score 0; languages tied
go to the one first in the alphabet; without any labelled row all is `und`; a null id
counts as empty text for the fold; an empty table gives an empty result; other columns pass
through, those named like a result give way to it.
"""

from __future__ import annotations

import gc
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartloom.llm.common import giving_way, model, positional

ROWS, CHARS = 256, 20_000
UNKNOWN = "und"
LETTERS, NO_LETTER = regex.compile(r"\p{L}+"), regex.compile(r"\P{L}")
#: Characters of an automaton that have a column of its table; longest run walked by table; characters of texts worked on at a time.
COLUMNS, LONG_RUN, SLICE = 128, 48, 1 << 18


class SuffixAutomaton:
    """Accepts every substring of a text."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and ch not in self.next[p]:
                self.next[p][ch] = new
                p = link[p]
            if p != -1:
                q = self.next[p][ch]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and self.next[p].get(ch) == q:
                        self.next[p][ch] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new

    def phrases(self, text: str) -> int:
        """Longest matches, one after the other, that make up the text; an unknown character is one of its own."""
        steps, state, count = self.next, 0, 0
        for ch in text:
            after = steps[state].get(ch)
            if after is None:
                count += 1
                after = steps[0].get(ch, 0) if state else 0
                if state and not after:
                    count += 1
            state = after
        return count + (state != 0)


def fold(id_column: str, folds: int) -> Column:
    text = F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % folds


def labelled_words(train: DataFrame, id_column: str, text_column: str, label_column: str, rows: int = ROWS, chars: int = CHARS) -> dict[str, str]:
    """Per language, distinct words of its sampled rows, separated by spaces; at most `chars` characters."""
    h = F.xxhash64(F.col(id_column).cast("string"))
    base = train.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    keys = base.groupBy(F.col(label_column).alias("lang"), F.pmod(h, F.lit(rows)).alias("bucket")).agg(F.min(h).alias("h"))
    wanted = sorted({r["h"] for r in keys.select("h").collect()})  # at most `rows` for each language
    if not wanted:
        return {}
    chosen = train.sparkSession.createDataFrame(pa.table({"h": pa.array(wanted, pa.int64())}))  # from a list it would take Python workers of its own
    picked = base.withColumn("h", h).join(F.broadcast(chosen), "h", "left_semi").select(F.col(label_column).alias("lang"), F.col(text_column).alias("text"))
    each = picked.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))).alias("word"))
    counted = each.groupBy("lang", "word").count()
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    reach = F.sum(F.length("word") + 1).over(first.rowsBetween(Window.unboundedPreceding, 0))
    out: dict[str, list[str]] = {}
    for row in counted.withColumn("reach", reach).where(F.col("reach") <= chars).orderBy("lang", "reach").collect():
        out.setdefault(row["lang"], []).append(row["word"])
    return {lang: " " + " ".join(words) + " " for lang, words in sorted(out.items())}


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Of each code point, whether it is a letter, as `LETTERS` says."""
    out = np.zeros(0x110000, bool)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):  # surrogates stand for no character
        for run in LETTERS.finditer("".join(map(chr, range(low, high)))):
            out[low + run.start() : low + run.end()] = True
    return out


class Steps:
    """An automaton's transitions as a table, for many runs of letters at a time."""

    def __init__(self, automaton: SuffixAutomaton, text: str, places: dict[str, int]) -> None:
        self.automaton = automaton
        common = {ch: i for i, (ch, _) in enumerate(Counter(" " + text).most_common(COLUMNS))}
        common.setdefault(" ", len(common))
        self.width = len(common) + 1  # the last column is for characters of no transition
        self.column = np.full(len(places) + 1, self.width - 1, np.int64)
        self.rare = np.zeros(len(places) + 1, bool)
        for ch in set(text) - common.keys():
            self.rare[places[ch]] = True
        for ch, i in common.items():
            self.column[places[ch]] = i
        cells = [(state * self.width + common[ch], after * self.width) for state, row in enumerate(automaton.next) for ch, after in row.items() if ch in common]
        self.flat = np.zeros(len(automaton.next) * self.width, np.int32 if len(automaton.next) * self.width < 1 << 31 else np.int64)
        at, after = np.array(cells, np.int64).reshape(-1, 2).T
        self.flat[at] = after

    def phrases(self, places: np.ndarray, start: np.ndarray, active: np.ndarray) -> np.ndarray:
        """`SuffixAutomaton.phrases` of runs, longest first, that begin at start; active[k] of them are longer than k."""
        column, state, count = self.column[places], np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for k, n in enumerate(active.tolist()):
            own = column[start[:n] + k]
            after = self.flat[state[:n] + own]
            miss = np.flatnonzero(after == 0)
            again = self.flat[own[miss]]
            count[miss] += 1 + ((state[miss] != 0) & (again == 0))
            after[miss] = again
            state[:n] = after
        return count + (state != 0)


class Parser:
    """Costs of texts in every language: runs of letters of many texts walk each automaton together."""

    def __init__(self, texts: dict[str, str]) -> None:
        self.langs = list(texts)
        self.weight = np.array([math.log2(len(t) + 1) for t in texts.values()])
        alphabet = {ch: i for i, ch in enumerate(sorted(set(" ".join(["", *texts.values(), ""]))))}
        self.space, self.places = alphabet.get(" ", 0), np.full(0x110000, len(alphabet), np.int32)
        self.places[[ord(ch) for ch in alphabet]] = list(alphabet.values())
        self.steps = [Steps(SuffixAutomaton(t), t, alphabet) for t in texts.values()]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and its runs of letters."""
        joined = f" {' '.join(texts)} "
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        inside = letters()[code]
        places = np.where(inside, self.places[code], self.space)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, size = edge[0::2], edge[1::2] - edge[0::2] + 2  # with the blank before and after
        text = np.searchsorted(np.cumsum([1 + len(t) for t in texts]), start, side="right")
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        order = np.argsort(-size, kind="stable")
        order = order[np.searchsorted(-size[order], -LONG_RUN) :]
        active = len(order) - np.searchsorted(size[order][::-1], np.arange(size[order].max(initial=0)), side="right")
        for i, steps in enumerate(self.steps):
            count = np.full(len(size), -1)
            count[order] = steps.phrases(places, start[order], active)
            if steps.rare.any():
                count[np.searchsorted(start, np.flatnonzero(steps.rare[places]), side="right") - 1] = -1
            for r in np.flatnonzero(count < 0).tolist():  # long runs, and those of a character without a column
                count[r] = steps.automaton.phrases(f" {joined[start[r] + 1 : start[r] + size[r] - 1]} ")
            out[:, i] = np.bincount(text, count, len(texts))
        return out, np.bincount(text, minlength=len(texts))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        count, runs = np.zeros((len(texts), len(self.langs)), np.int64), np.zeros(len(texts), np.int64)
        for own, parts in slices(texts):
            found, seen = self.counts(parts)
            np.add.at(count, own, found)
            np.add.at(runs, own, seen)
        cost = count * self.weight
        best = cost.argmin(axis=1)
        least = cost[np.arange(len(texts)), best]
        score = 1 - least / np.maximum(np.partition(cost, 1, axis=1)[:, 1], 1.0) if len(self.langs) > 1 else np.ones(len(texts))
        return [(self.langs[b], x) if n else (UNKNOWN, 0.0) for b, x, n in zip(best.tolist(), score.tolist(), runs.tolist(), strict=True)]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-case texts, some at a time, and the number of each; long ones in parts that end before a character that is no letter."""
    own, parts, size = [], [], 0
    for i, t in enumerate(texts):
        low, a = (t or "").lower(), 0
        while a < len(low):
            end = NO_LETTER.search(low, a + SLICE) if len(low) > a + SLICE else None
            b = end.start() if end else len(low)
            own.append(i)
            parts.append(low[a:b])
            size, a = size + b - a, b
            if size >= SLICE:
                yield own, parts
                own, parts, size = [], [], 0
    if own:
        yield own, parts


@model
@lru_cache(maxsize=1)
def parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(texts))


def identify(docs: DataFrame, model: dict[str, str], text_column: str = "text") -> DataFrame:
    """docs plus lang_pred and score (0 to 1: how much cheaper the language is than the next)."""
    plain, names = positional(giving_way(docs, "lang_pred", "score"))
    at, texts = names.index(text_column), tuple(model.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(texts)
        gc.freeze()  # a model lives as long as its worker
        for batch in batches:
            found = own.predict_all(batch.column(at).to_pylist())
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    schema = StructType(plain.schema.fields + StructType.fromDDL("lang_pred string, score double").fields)
    return plain.mapInArrow(run, schema).toDF(*names, "lang_pred", "score")


def cross_parse_language(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """docs plus held_out, lang_pred and score, learned from rows of the other folds."""
    train = docs.where(fold(id_column, folds) != held)
    model = labelled_words(train.select(id_column, text_column, label_column), id_column, text_column, label_column)
    return identify(docs.withColumn("held_out", fold(id_column, folds) == held), model, text_column)
