"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import written


def starred(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least one: larger neighbours (large star) or smaller ones and the node itself (small star)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a")
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(hung.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of linked longs, a != b -> (node, component): the least node reachable, for nodes with edges.

    Each round is written to the shared folder, so lineage stays short and a lost
    executor costs one round. Rounds grow with the logarithm of the longest chain.
    """
    flat = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    seen = digest(flat)
    while seen[0]:
        flat = written(starred(starred(flat, large=True), large=False), "stars")
        now = digest(flat)
        if now == seen:
            break
        seen = now
    return flat.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(flat.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
