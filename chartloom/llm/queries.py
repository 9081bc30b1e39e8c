"""One thin query per training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import chroma, decontamination, fm_index, langid, packing, simhash, suffix_array, toxicity, url_reputation, warc
from chartloom.llm.common import table


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_array.digest(suffix_array.suffix_array_dedup(docs))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.best_fit_pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fm_index.digest(fm_index.fm_index_dedup(docs))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.digest(simhash.simhash_components(docs))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.cross_parse_language(docs).select("doc_id", "held_out", "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.lookup(warc.write_archive(pages), pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.latent_decontamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op9_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables hold no recordings: each embedding is played as a melody and fingerprinted as audio."""
    media = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = chroma.align(media, "vec_id", "embedding", chroma.melody)
    return found.select(F.col("id").alias("vec_id"), "n_prints", "class_id", "links", F.transform("matches", lambda m: m["class_id"]).alias("match_ids"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge(pages, labels.select(F.col("doc_id").alias("id"), bad.alias("bad"))).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_suffix_array": op1_suffix_array, "op2_toxicity": op2_toxicity, "op3_packing": op3_packing, "op4_fm_index": op4_fm_index, "op5_simhash": op5_simhash, "op6_language": op6_language, "op7_warc": op7_warc, "op8_decontamination": op8_decontamination, "op9_chroma": op9_chroma, "op10_url_reputation": op10_url_reputation, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_array": suffix_array.oracle(), "op4_fm_index": fm_index.oracle(), "op7_warc": warc.oracle(), "op10_url_reputation": url_reputation.oracle()}
