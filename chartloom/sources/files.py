"""Files in and out: documents as bytes, block files, nested specs, JSON lines."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.keys import document_key

BLOCKS = "doc_id string, ord int, page int, text string, x0 double, y0 double, x1 double, y1 double"
FILES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Settings:
    """Where things are; every missing variable is named at once."""

    warehouse: str
    inbox: str

    @classmethod
    def read(cls, env_file: str | None = None, env: dict[str, str] | None = None) -> Settings:
        values: dict[str, str] = {}
        if env_file and os.path.exists(env_file):
            with open(env_file, encoding="utf-8") as f:
                pairs = (line.strip().partition("=") for line in f if "=" in line and not line.lstrip().startswith("#"))
                values = {k.strip(): v.strip().strip("'\"") for k, _, v in pairs}
        values |= os.environ if env is None else env
        missing = [n for n in ("CHART_WAREHOUSE", "CHART_INBOX") if not values.get(n)]
        if missing:
            raise ValueError(f"missing settings: {', '.join(missing)}")
        return cls(values["CHART_WAREHOUSE"], values["CHART_INBOX"])


def is_document(path: Column) -> Column:
    return F.lower(path).endswith(".pdf")


def documents(spark: SparkSession, *paths: str) -> DataFrame:
    """path, length, document_id of document files, in order of path; other suffixes are skipped in any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).where(is_document(F.col("path")))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", document_key(F.col("content")).alias("document_id")).orderBy("path")


def same_content(spark: SparkSession, folder: str, size: int, digest: str) -> DataFrame:
    """Files of a size and then of a digest: contents are read only where the size fits."""
    files = spark.read.format("binaryFile").load(folder).where(F.col("length") == size)
    return files.where(document_key(F.col("content")) == digest).select("path")


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """Positioned text blocks, one printed line each; blank ones are dropped."""
    return spark.read.schema(BLOCKS).json(path).withColumn("text", F.trim("text")).where("text != ''")


def specs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json_lines(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def events(rows: DataFrame, column: str = "body") -> DataFrame:
    """Notifications of either envelope -> bucket, name, accepted. Malformed, foreign and unsuitable ones are skipped, not failed."""
    body = F.from_json(column, "type string, bucket string, name string, data struct<bucket: string, name: string>")
    found = rows.withColumn("_b", body)
    kind = F.coalesce("_b.type", *(["type"] if "type" in rows.columns else []), F.lit(""))
    out = found.select(F.coalesce("_b.data.bucket", "_b.bucket").alias("bucket"), F.coalesce("_b.data.name", "_b.name").alias("name"), kind.alias("kind"))
    return out.withColumn("accepted", F.coalesce(F.col("kind").contains("finalized") & is_document(F.col("name")), F.lit(False)))



def seed_drugs(spark: SparkSession) -> DataFrame:
    """The drug lookup's own rows."""
    from chartloom.schemas import DRUGS, SCHEMAS

    return spark.createDataFrame(DRUGS, SCHEMAS["ref_drug_class"])


def register(spark: SparkSession, warehouse, views: dict) -> None:
    """Temporary views of all tables of a warehouse, and of the curated views made from them."""
    from chartloom.schemas import SCHEMAS

    tables = {name: warehouse.read(name) for name in SCHEMAS}
    for name, df in (tables | {name: made(tables) for name, made in views.items()}).items():
        df.createOrReplaceTempView(name)
