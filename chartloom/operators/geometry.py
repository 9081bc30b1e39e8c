"""Positioned blocks to lines, labels and regions.

blocks: doc_id, ord, page, text, x0, y0, x1, y1; pages: doc_id, page, width, height.
Only the header cut and the gutter need a page's blocks in sequence: one Arrow stage per
page. All else is native.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values, in points or as shares of the page.
ROW = 3.0
FALLBACK_HEADER, LEAST_GAP, TALL_RUN, GAP_TO_ROW = 0.18, 3.0, 36.0, 2.0
GUTTER_FROM, GUTTER_TO, GUTTER_BINS, GUTTER_ROWS, RAIL_RATIO = 0.10, 0.45, 200, 0.05, 0.5
FOOTER_BAND, COLUMN_GAP = 0.90, 0.15


def row_of(y: Column | str) -> Column:
    """Baseline row: half-even, so blocks a hair apart share a row."""
    return F.rint((F.col(y) if isinstance(y, str) else y) / ROW).cast("long")


def reading_key() -> list[Column]:
    return [F.col("page"), row_of("y0"), F.col("x0"), F.col("ord")]


def joined_text(by: list[str], blocks: DataFrame, separator: str = " ") -> DataFrame:
    """Text of each group in reading order."""
    ordered = F.array_sort(F.collect_list(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(reading_key())], "text")))
    return blocks.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), separator).alias("text"))


def lines(blocks: DataFrame, by: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """One row per visual line: least x0 and y0, largest x1 and y1, text joined left to right."""
    ordered = F.array_sort(F.collect_list(F.struct("x0", "ord", "text")))
    return blocks.withColumn("row", row_of("y0")).groupBy(*by, "row").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.min("ord").alias("ord"), F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))


def page_labels(blocks: DataFrame) -> DataFrame:
    """The number of the first block that reads 'Page N'."""
    number = F.nullif(F.regexp_extract("text", r"(?i)\bpage\s+(\d+)", 1), F.lit(""))
    return blocks.where(number.isNotNull()).groupBy("doc_id", "page").agg(F.min_by(number.cast("int"), F.struct(row_of("y0"), "x0", "ord")).alias("page_label"))


def runs(flags: np.ndarray) -> np.ndarray:
    """(start, end) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(int)))
    return edge.reshape(-1, 2)


def header_cut(y0: np.ndarray, y1: np.ndarray, height: float) -> float:
    """Middle of the first trusted gap between bands of ink, or a fixed share of the page.

    Runs of occupied one-point bins alternate with gaps. A gap is trusted after two runs,
    after enough inked height, or when it is over twice the only run above it; and it must
    be larger than every gap before it.
    """
    bins = max(1, round(height))
    size = height / bins
    first = np.maximum((y0 / size).astype(int), 0)
    last = np.minimum((np.minimum(y1, height) / size).astype(int), bins - 1)
    ink = np.zeros(bins + 1, int)
    use = last >= first
    np.add.at(ink, first[use], 1)
    np.add.at(ink, last[use] + 1, -1)
    bands = runs(np.cumsum(ink)[:bins] > 0)
    inked = np.cumsum((bands[:, 1] - bands[:, 0]) * size)
    widest = LEAST_GAP
    for i in range(len(bands) - 1):
        gap = (bands[i + 1, 0] - bands[i, 1]) * size
        trusted = i >= 1 or inked[i] >= TALL_RUN or gap > GAP_TO_ROW * inked[0]
        if trusted and gap > widest:
            return (bands[i, 1] + bands[i + 1, 0]) / 2 * size
        widest = max(widest, gap)
    return height * FALLBACK_HEADER


def gutter(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, width: float) -> tuple[float, float] | None:
    """The widest band of the left part that few rows cross; of equals the first."""
    if not len(x0):
        return None
    size = width / GUTTER_BINS
    row = np.unique(np.rint(y0 / ROW), return_inverse=True)[1]
    crossed = np.zeros((GUTTER_BINS, row.max() + 1), bool)
    for r, a, b in zip(row, np.maximum((x0 / size).astype(int), 0), np.minimum((x1 / size).astype(int), GUTTER_BINS - 1), strict=True):
        crossed[a : b + 1, r] = True
    free = crossed.sum(axis=1) <= GUTTER_ROWS * crossed.shape[1]
    low, high = int(GUTTER_BINS * GUTTER_FROM), int(GUTTER_BINS * GUTTER_TO)
    bands = runs(free[low : high + 1]) + low
    if not len(bands):
        return None
    best = bands[np.argmax(bands[:, 1] - bands[:, 0])]
    return (best[0] * size, best[1] * size) if best[1] - best[0] >= 2 else None


def page_regions(page: pd.DataFrame) -> pd.Series:
    """header, sidebar or body for each block of a page; every block gets one."""
    width, height = float(page["width"].iloc[0]), float(page["height"].iloc[0])
    x0, x1, y0, y1 = (page[c].to_numpy(float) for c in ("x0", "x1", "y0", "y1"))
    below = y0 >= header_cut(y0, y1, height)
    region = np.where(below, "body", "header").astype(object)
    band = gutter(x0[below], x1[below], y0[below], width)
    if band:
        left, right = below & (x1 <= band[1]), below & (x1 > band[1])
        if left.any() and right.any() and x1[left].max() - x0[left].min() <= RAIL_RATIO * (x1[right].max() - band[1]):
            region[left] = "sidebar"
    return pd.Series(region, index=page.index)


def with_regions(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """blocks with their page's width and height, and region."""
    joined = blocks.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"])
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in joined.schema)}, region string"
    return joined.groupBy("doc_id", "page").applyInPandas(lambda pdf: pdf.assign(region=page_regions(pdf)), schema)


def repeated_footers(blocks: DataFrame, pages: DataFrame, by: list[str]) -> DataFrame:
    """Texts in the bottom band of every page of a group, in the first page's order."""
    low = blocks.drop("height").join(pages.select("doc_id", "page", "height"), ["doc_id", "page"])
    foot = low.where(F.col("y0") >= F.col("height") * FOOTER_BAND).withColumns({"text": F.trim("text"), "place": F.struct("page", row_of("y0").alias("row"), "x0", "ord")})
    return in_every(foot, low, by, "text", "page", F.min("place").alias("place"))


def in_every(rows: DataFrame, every: DataFrame, by: list[str], item: str, unit: str, *more: Column) -> DataFrame:
    """(by, item) of the items that rows has for each unit that `every` has in the group; relational division."""
    total = every.groupBy(*by).agg(F.count_distinct(unit).alias("_all"))
    met = rows.groupBy(*by, item).agg(F.count_distinct(unit).alias("units"), *more)
    both = met.join(total, by) if by else met.join(F.broadcast(total))
    return both.where("units = _all").drop("_all")


def value_below(labels: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """labels(keys, label_id, x0, x1, y0) x cells(keys, ord, text, x0, x1, y0): nearest overlapping cell below each label."""
    a, b = labels.alias("a"), cells.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    overlap = F.least("a.x1", "b.x1") > F.greatest("a.x0", "b.x0")
    met = a.join(b, [*same, F.col("b.y0") > F.col("a.y0"), overlap])
    return met.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.label_id").alias("label_id")).agg(F.min_by("b.text", F.struct(F.col("b.y0") - F.col("a.y0"), "b.ord")).alias("value"))


def gap_sessions(rows: DataFrame, keys: list[str], x: str, tie: str, widest: Column, target: str = "column") -> DataFrame:
    """target: a number that grows by one where x lies over `widest` beyond the row before it."""
    w = Window.partitionBy(*keys).orderBy(x, tie)
    wide = F.coalesce((F.col(x) - F.lag(x).over(w)) > widest, F.lit(False)).cast("int")
    return rows.withColumn("_wide", wide).withColumn(target, F.sum("_wide").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_wide")


def text_columns(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Column number of each block: a new one where left edges lie over 15% of the span apart."""
    span = Window.partitionBy(*keys)
    return gap_sessions(blocks, keys, "x0", "ord", COLUMN_GAP * (F.max("x1").over(span) - F.min("x0").over(span)))
