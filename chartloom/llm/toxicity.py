"""Operator 2: toxicity by a weighted lexicon, matched with Aho-Corasick.

Text is lower-cased, homoglyphs and accents become plain letters, digits and signs that
stand for letters become those letters in words that hold a letter (other digits stay as
they are), and all else becomes spaces. The automaton then
finds lexicon entries (whole words, or beginnings of words) and exception phrases; a hit
inside an exception phrase does not count. Hits are summed by weight and normalised by
length, and a logistic curve gives the score.

Fitted on a bounded sample of labelled rows: the `toxic_rows` and `clean_rows` rows of
smallest id hash of each label. One half gives the lexicon (log-odds of document counts)
and the exceptions (pairs of words around entries that speak for clean text), the other
half the curve. Scores cover whole texts.

Defined results: null and empty text score as a text without hits; without labels of both
kinds all scores are 0; several labels for one id count as toxic if one is; a null id counts
as empty text for the fold; an empty table gives an empty result; other columns pass through
whatever their names.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartloom.llm.common import giving_way, positional
from chartloom.llm.langid import fold

TOXIC_ROWS, CLEAN_ROWS, LEXICON, EXCEPTIONS = 6_000, 9_000, 4_000, 1_000
SUPPORT, LEAST_ODDS, PREFIX = 4, 1.5, 5
#: Letters that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "|": "l"}
AS_LETTERS = str.maketrans(SUBSTITUTES)
AS_SPACES = str.maketrans({c: " " for c in SUBSTITUTES if not c.isdigit()})


class Folding(dict):
    """str.translate table, filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        ch = chr(code).lower()
        if ch in HOMOGLYPHS or ch in SUBSTITUTES:
            out = HOMOGLYPHS.get(ch) or ch
        else:
            plain = "".join(x for x in unicodedata.normalize("NFKD", ch).lower() if x.isalnum())
            out = "".join(HOMOGLYPHS.get(x, x) for x in plain) or ("" if unicodedata.category(ch) in ("Cf", "Mn") else " ")
        self[code] = out
        return out


FOLDING = Folding()


def folded(text: str | None) -> list[str]:
    """Words after folding. A digit or sign stands for a letter only in a word that holds a letter; else signs are spaces."""
    out: list[str] = []
    for word in (text or "").lower().translate(FOLDING).split():
        if word.isalpha():
            out.append(word)
        elif any(c.isalpha() for c in word):
            out.append(word.translate(AS_LETTERS))
        else:
            out += word.translate(AS_SPACES).split()
    return out


class Lexicon(NamedTuple):
    entries: tuple[tuple[str, float], ...]  # " word " or " begin", and its weight
    exceptions: tuple[str, ...]  # " two words "
    curve: tuple[float, ...]  # of the features, bias last


@lru_cache(maxsize=2)
def automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for entry, weight in lexicon.entries:
        found.add_word(entry, (len(entry), weight))
    for phrase in lexicon.exceptions:
        found.add_word(phrase, (len(phrase), None))
    found.make_automaton()
    return found


def measures(lexicon: Lexicon, text: str | None) -> tuple[float, ...]:
    """Weight of hits by length, weight of hits, the heaviest hit, length."""
    words = folded(text)
    hits, excused = [], []
    if lexicon.entries or lexicon.exceptions:
        for end, (size, weight) in automaton(lexicon).iter(f" {' '.join(words)} "):
            (excused if weight is None else hits).append((end - size + 1, end, weight))
    if excused:  # of the phrases that begin no later than a hit, does the one that reaches furthest hold it?
        excused.sort()
        begins, reach = [a for a, _, _ in excused], list(accumulate((b for _, b, _ in excused), max))
        hits = [h for h in hits if not (i := bisect_right(begins, h[0])) or reach[i - 1] < h[1]]
    best: dict[int, float] = {}
    for start, _, weight in hits:  # of entries that begin at one word, the heaviest
        best[start] = max(best.get(start, 0.0), weight)
    total = sum(best.values())
    return total / np.sqrt(len(words) + 10.0), np.log1p(total), max(best.values(), default=0.0), np.log1p(len(words))


def probability(curve: tuple[float, ...], features: np.ndarray) -> np.ndarray:
    z = features @ np.array(curve[:-1]) + curve[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton's method, on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * (a.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    out = w[:-1] / scale
    return (*out.tolist(), float(w[-1] - (out * mean).sum()))


def features_of(words: list[str]) -> set[str]:
    return {f" {w} " for w in words} | {f" {w[:PREFIX]}" for w in words if len(w) > PREFIX}


def counted(rows: DataFrame, featurise) -> DataFrame:
    """(feature, toxic, clean): documents of each label that have it; summed in each batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                count[label].update(featurise(folded(text)))
            keys = list(count[0].keys() | count[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()), pa.array([count[0][k] for k in keys], pa.int64())], ["feature", "toxic", "clean"])

    return rows.select("text", "label").mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(toxic: int, clean: int):
    return F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))


def learned(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Lexicon:
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max((F.col(label_column) == 1).cast("int")).alias("label"))
    ranked = known.withColumn("h", F.xxhash64("id"))
    picked = [r for label, n in ((1, toxic_rows), (0, clean_rows)) for r in ranked.where(F.col("label") == label).orderBy("h").limit(n).collect()]
    chosen = docs.sparkSession.createDataFrame([(r["id"], r["label"], int(r["h"] % 2)) for r in picked], "id long, label int, half int")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "id").repartition(12, "id")
    learn, curve = rows.where("half = 0"), rows.where("half = 1")
    size = Counter((r["label"]) for r in picked if r["h"] % 2 == 0)
    if not size[0] or not size[1]:
        return Lexicon((), (), (0.0,) * 4 + (-30.0,))
    odds = log_odds(size[1], size[0])
    top = counted(learn, features_of).where((F.col("toxic") >= SUPPORT) & (odds >= LEAST_ODDS)).select("feature", odds.alias("w")).orderBy(F.desc("w"), "feature").limit(LEXICON).collect()
    entries = tuple(sorted((r["feature"], float(r["w"])) for r in top))
    words = {e.strip() for e, _ in entries if e.endswith(" ")}

    def around(found: list[str]) -> set[str]:
        return {f" {a} {b} " for a, b in zip(found, found[1:], strict=False) if a in words or b in words}

    excuse = counted(learn, around).where((F.col("clean") >= SUPPORT) & (log_odds(size[1], size[0]) <= -0.5)).orderBy(F.desc("clean"), "feature").limit(EXCEPTIONS).collect()
    lexicon = Lexicon(entries, tuple(sorted(r["feature"] for r in excuse)), ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measures(lexicon, t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[pa.array([float(r[i]) for r in x], pa.float64()) for i in range(4)], batch.column(1)], [*"abcd", "label"])

    points = curve.select("text", "label").mapInArrow(run, "a double, b double, c double, d double, label int").orderBy(*"abcd", "label").collect()
    if len({p["label"] for p in points}) < 2:
        return lexicon._replace(curve=(0.0, 1.0, 0.0, 0.0, -2.0))
    data = np.array([tuple(p) for p in points], float)
    return lexicon._replace(curve=fitted_curve(data[:, :4], data[:, 4]))


def score(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> DataFrame:
    """docs plus score."""
    plain, names = positional(giving_way(docs, "score"))
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([measures(lexicon, t) for t in batch.column(at).to_pylist()], float).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(probability(lexicon.curve, x), pa.float64())], [*batch.schema.names, "score"])

    return plain.mapInArrow(run, StructType(plain.schema.fields + StructType.fromDDL("score double").fields)).toDF(*names, "score")


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", folds: int = 5, held: int = 0) -> DataFrame:
    """docs plus held_out, score and predicted, learned from labelled rows of the other folds."""
    train = labels.where(fold(id_column, folds) != held)
    lexicon = learned(docs, train, id_column, text_column, label_column)
    scored = score(docs.withColumn("held_out", fold(id_column, folds) == held), lexicon, text_column)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
