"""Incremental ingestion: files as they land, each micro-batch published as one version.

A reader turns one document's bytes into pages and blocks. It runs for each document by
itself, so one that cannot be read becomes a failed document with an issue and costs the
others of its batch nothing. What fails beyond documents (storage, memory) is raised: the
stream stops and its checkpoint stays, so the batch is read again.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.keys import document_key
from chartloom.operators import extract
from chartloom.operators.store import AUDIT, Warehouse, counts
from chartloom.schemas import SCHEMAS
from chartloom.sources.files import FILES, is_document
from chartloom.sources.scratch import Scratch

#: (page, width, height, blocks as (text, x0, y0, x1, y1)) of each page of a document.
Page = tuple[int, float, float, list[tuple[str, float, float, float, float]]]
Reader = Callable[[bytes], Iterable[Page]]
READ = "document_id string, gcs_uri string, file_name string, file_bytes long, arrived timestamp, error string, pages array<struct<page: int, width: double, height: double, blocks: array<struct<text: string, x0: double, y0: double, x1: double, y1: double>>>>"
#: The status of a run by that of its document.
RUN_STATUS = {"ok": "succeeded", "partial": "partial", "failed": "failed"}


class Options(NamedTuple):
    model: Callable[[str], str] | None = None
    model_name: str | None = None
    trigger: str = "event"
    version: str = extract.VERSION


def read_documents(files: DataFrame, reader: Reader) -> DataFrame:
    """files(path, modificationTime, length, content) -> READ: one row a document, with its pages or the error that reading it raised."""
    rows = files.where(is_document(F.col("path"))).select(document_key(F.col("content")).alias("document_id"), "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").cast("long").alias("file_bytes"), "modificationTime", "content")

    def opened(content: bytes) -> tuple[str | None, list[dict] | None]:
        try:
            pages = [{"page": n, "width": w, "height": h, "blocks": [dict(zip(("text", "x0", "y0", "x1", "y1"), b, strict=True)) for b in blocks]} for n, w, h, blocks in reader(bytes(content))]
        except Exception as e:  # noqa: BLE001  a document may be broken in any way
            return f"{type(e).__name__}: {e}"[:1000], None
        return None, pages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [opened(c) for c in pdf["content"]]
            yield pd.DataFrame({"document_id": pdf["document_id"], "gcs_uri": pdf["path"], "file_name": pdf["file_name"], "file_bytes": pdf["file_bytes"], "arrived": pdf["modificationTime"], "error": [e for e, _ in found], "pages": [p for _, p in found]})

    return rows.mapInPandas(run, READ)


def parts(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, pages, blocks) of READ rows, as `extract` takes them. Copies of one content are one document, under the name that came last."""
    last = documents.groupBy("document_id").agg(F.max_by(F.struct(*[c for c in documents.columns if c != "document_id"]), F.struct("arrived", "gcs_uri")).alias("d")).select("document_id", "d.*")
    files = last.select("document_id", "gcs_uri", "file_name", "file_bytes", "error", "arrived")
    paged = last.select(F.col("document_id").alias("doc_id"), F.inline("pages"))
    blocks = paged.select("doc_id", "page", F.posexplode("blocks").alias("ord", "b")).select("doc_id", "ord", "page", F.trim("b.text").alias("text"), "b.x0", "b.y0", "b.x1", "b.y1")
    return files, paged.select("doc_id", "page", "width", "height"), blocks


def last_document_wins(bundle: dict[str, DataFrame], arrival: DataFrame) -> dict[str, DataFrame]:
    """Of several documents in one batch, the last to arrive owns an encounter, with all its children; every row gets its document's arrival as `_ord`.

    arrival(document_id, arrived) orders documents by modification time and path.
    """
    came = arrival.select(F.col("document_id").alias("_doc"), F.col("arrived").alias("_ord"))
    owner = bundle["encounters"].join(came, F.col("source_document_id") == F.col("_doc")).groupBy("encounter_id").agg(F.max_by("source_document_id", "_ord").alias("_owner"))
    out = {}
    for name, rows in bundle.items():
        key = next((c for c in ("source_document_id", "document_id") if c in rows.columns), None)
        if "encounter_id" in rows.columns and "source_document_id" in rows.columns:
            rows = rows.join(owner, "encounter_id").where(F.col("source_document_id") == F.col("_owner")).drop("_owner")
        out[name] = rows.join(came, F.col(key) == F.col("_doc"), "left").drop("_doc") if key else rows
    return out


def ingest(warehouse: Warehouse, files: DataFrame, reader: Reader, options: Options | None = None, run: str | None = None) -> int | None:
    """Read, extract and write a batch of files under one version (None: no document among them), with an audit row a document."""
    options = options or Options()
    started = now()
    scratch = Scratch(warehouse.spark)
    found = None
    try:
        read = scratch.keep(read_documents(files, reader), "read")
        if read.isEmpty():
            return None
        listed, pages, blocks = parts(read)
        found = extract.extract(listed.drop("arrived"), pages, blocks, options.model, options.model_name, run, options.version)
        arrival = listed.select("document_id", F.struct("arrived", "gcs_uri").alias("arrived"))
        version = warehouse.write(last_document_wins(found.tables, arrival))
        warehouse.record_runs(run_rows(found.tables, listed, options, started))
        return version
    finally:
        scratch.release()
        if found:
            found.release()


def run_rows(tables: dict[str, DataFrame], files: DataFrame, options: Options, started: datetime.datetime) -> DataFrame:
    """An audit row for each document: its status, and the encounters and issues it has."""
    visits = tables["encounters"].groupBy(F.col("source_document_id").alias("document_id")).agg(F.count("*").alias("encounters_written"))
    said = tables["ingestion_issues"].groupBy("document_id").agg(F.count_if(F.col("severity") == "warn").alias("issues_warn"), F.count_if(F.col("severity") == "error").alias("issues_error"))
    rows = tables["documents"].select("document_id", "gcs_uri", "parse_status", "pipeline_version").join(visits, "document_id", "left").join(said, "document_id", "left").join(files.select("document_id", F.col("error").alias("error_detail")), "document_id", "left")
    status = F.col("parse_status")
    for parsed, name in RUN_STATUS.items():
        status = F.when(F.col("parse_status") == parsed, F.lit(name)).otherwise(status)
    given = {"run_id": F.expr("replace(uuid(), '-', '')"), "trigger_source": F.lit(options.trigger), "status": status, "started_at": F.lit(started), "finished_at": F.lit(now())}
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("encounters_written", "issues_warn", "issues_error")}
    return rows.withColumns(given | filled).select(*SCHEMAS[AUDIT].fieldNames())


def now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC).replace(tzinfo=None)


def batch_writer(warehouse: Warehouse, reader: Reader, options: Options | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body. Documents never fail it; what else fails is recorded and raised."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = now()
        try:
            ingest(warehouse, batch, reader, options)
        except Exception as e:
            warehouse.record_run({"trigger_source": (options or Options()).trigger, "status": "failed", "started_at": started, "finished_at": now(), "error_detail": f"batch {batch_id}: {type(e).__name__}: {e}"[:1000]})
            raise

    return write


def ingest_available(spark: SparkSession, folder: str, warehouse: Warehouse, reader: Reader, checkpoint: str, options: Options | None = None) -> None:
    """Every document that has landed since the last call, once."""
    stream = spark.readStream.schema(FILES).format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    query = stream.writeStream.foreachBatch(batch_writer(warehouse, reader, options)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def backfill(spark: SparkSession, paths: list[str], warehouse: Warehouse, reader: Reader, options: Options | None = None) -> int | None:
    """The same for a list of files or folders; a failure is raised."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return ingest(warehouse, files, reader, (options or Options())._replace(trigger="manual"))


def drift(warehouse: Warehouse, files: DataFrame, reader: Reader, without: tuple[str, ...] = ("ingested_at", "created_at", "ingest_run_id", "file_name", "gcs_uri")) -> list[str]:
    """Tables whose rows change when the same input is written again; empty when writes converge."""
    before = warehouse.versions()[-1]
    ingest(warehouse, files, reader)
    return warehouse.verify(before, without)


def replay(spark: SparkSession, folder: str, warehouse: Warehouse, reader: Reader) -> list[str]:
    """Every document of a folder by itself, in order of path, and then all once more: the tables that drifted."""
    files = spark.read.format("binaryFile").load(folder).where(is_document(F.col("path")))
    for row in files.select("path").orderBy("path").toLocalIterator():
        backfill(spark, [row["path"]], warehouse, reader)
    return drift(warehouse, files, reader)


def upserted(warehouse: Warehouse, table: str, stream: DataFrame, checkpoint: str, keys: list[str], order: str) -> None:
    """A stream of rows into one table by key, the last by `order` staying; each micro-batch is a version."""
    from chartloom.operators.store import last_wins, upsert

    def write(batch: DataFrame, batch_id: int) -> None:
        stage = last_wins(batch, keys, F.col(order))
        warehouse.publish({table: upsert(warehouse.read(table), stage.select(*SCHEMAS[table].fieldNames()), keys)})

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def table_counts(warehouse: Warehouse) -> DataFrame:
    return counts({n: warehouse.read(n) for n in SCHEMAS})
