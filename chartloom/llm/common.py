"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's limit of an Arrow batch in bytes, and the one of `lean`.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20
MASK64 = (1 << 64) - 1
PRIME = 0x9E3779B97F4A7C15 | 1
PRIME_INV = pow(PRIME, -1, 1 << 64)
LAST_ID = (1 << 63) - 1
#: Folders of the tables that `written` made and that were not discarded.
WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean(spark: SparkSession) -> None:
    """Rows go to Python in batches of BATCH_BYTES, not of 10,000 rows of any length: an executor holds some at both ends. A limit that the session has set stays."""
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. One of our own only where that is unset and Spark runs in one process."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"file://{tempfile.mkdtemp(prefix='chartloom-')}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """`written`, in buckets by the hash of a column: rows that meet this table by that column come to it, it is not moved.

    Only a catalog's table can have buckets; its name goes at once, its files stay for the table that is returned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    name = f"spark_catalog.default.{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(name)
    WRITTEN.append(path)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables that nothing reads any more."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(hadoop).delete(at, True)
        WRITTEN.remove(path)


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text or binary column, from one aggregate over the whole table."""
    return int(df.agg(F.sum(F.octet_length(F.col(column))).alias("n")).first()["n"] or 0)


def parts_for(size: int, each: int) -> int:
    return max(1, math.ceil(size / each))


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Columns renamed to _c0, _c1, ...: extra columns may clash in name and still pass through."""
    names = df.columns
    return df.toDF(*[f"_c{i}" for i in range(len(names))]), names


def giving_way(df: DataFrame, *results: str) -> DataFrame:
    """df without columns named like an operator's results."""
    return df.drop(*results)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs stay equal, nearby ones spread out."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """PRIME**i and PRIME**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", PRIME), ("down", PRIME_INV)):
                steps = np.full(n, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """c with c[i] = sum of values[t] * PRIME**t over t < i."""
    up, _ = POWERS.upto(max(1, len(values)))
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=c[1:])
    return c


def range_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] that does not depend on where the range lies."""
    _, down = POWERS.upto(len(c))
    return mix((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64))


def binary_rows(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Cells of a string or binary column as bytes; null gives b''."""
    kind = pa.large_binary() if column.type in (pa.large_string(), pa.large_binary()) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def packed_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def unpacked_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


MODELS: list = []


def model(cached):
    """Mark a worker's cached model as one that a later operator may drop."""
    MODELS.append(cached)
    return cached


def forget_models() -> None:
    """Drop what earlier operators left in this worker."""
    held = [cached for cached in MODELS if cached.cache_info().currsize]
    for cached in held:
        cached.cache_clear()
    if held:
        trim()


def trim() -> None:
    """Give freed memory back to the system: workers live on, and an executor counts them all."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
