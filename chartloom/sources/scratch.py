"""Intermediate tables in the folder that all executors share: a short plan after each, and nothing lost with an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where that is unset and Spark runs in one process."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='chartloom-')}"


class Scratch:
    """Tables of one run, under one folder; removed together."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def release(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
