"""The corpus pipeline: five stages over documents, each reread from the last one's Parquet.

Every stage takes (spark, docs, sf_dir) and keeps the columns of documents, but for the
last, which returns packed pieces. Stages judge all of their own input. They limit the bytes
of the session's Arrow batches, unless the session does so itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import decontamination, langid, near_copies, packing, suffix_array
from chartloom.llm.common import WRITTEN, discard, lean, table, written

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near-duplicates: shingles of five words, and this similarity or more.
WORDS, SIMILARITY = 5, 0.8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents of no language go. The predicted language fills a missing one."""
    found = langid.cross_parse_language(docs)
    kept = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of linked documents the one of smallest id stays, once; rows without an id stay.

    Its fingerprints meet through its covering masks; pairs that are similar beyond that distance meet by rare shingles; texts decide.
    """
    found = near_copies.near_copies(docs, words=WORDS, similarity=SIMILARITY)
    stay = found.where(F.col("stays") & F.col("id").isNotNull()).select(F.col("id").alias("_id"), F.col("body").alias("_body")).distinct()
    told = docs.where(F.col("doc_id").isNotNull()).withColumn("_body", near_copies.body_of(F.col("text"))).withColumnRenamed("doc_id", "_id")
    known = told.join(stay, ["_id", "_body"], "left_semi").dropDuplicates(["_id", "_body"]).withColumnRenamed("_id", "doc_id")
    return known.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: 50-byte strings that an earlier document has are cut out; documents of nothing else go."""
    found = suffix_array.suffix_array_dedup(docs)
    kept = found.where(~((F.size("spans") > 0) & (F.trim("kept_text") == "")))
    return kept.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long")).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark passage go, whatever their id; other texts under that id stay."""
    key = F.md5(F.col("text").cast("binary"))
    leaks = decontamination.latent_decontamination(docs, table(spark, sf_dir, "benchmark"), row_key=key).select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct()
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key")), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces of at most 2048 tokens, placed in sequences."""
    return packing.best_fit_pack(docs.select("doc_id", "text"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [(stage.__name__, in_small_batches(stage)) for stage in (language, near_duplicates, repeated_substrings, decontaminated, packed)]

#: Suffix automata, fingerprints of shingles, singular vectors and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; tables of a stage are removed once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), list(WRITTEN)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, [p for p in WRITTEN[:-1] if p not in before])
    return docs
