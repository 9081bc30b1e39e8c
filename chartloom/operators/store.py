"""A warehouse of versioned Parquet tables: keyed upsert, scoped sweep, refresh, publish, restore.

Parquet takes no MERGE, so a write computes the changed tables whole and publishes them under
one version: a marker file per version, written last, makes it current. Readers see all of a
document's tables or none, and older versions are backups.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.schemas import MERGE_KEYS, SCHEMAS, SWEPT


def last_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the last by `order`."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order.desc())))
    return ranked.where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """Full-row replace by key, and insert; NULLs of the stage overwrite. NULL keys match NULL keys."""
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    kept = target.alias("t").join(stage.select(*keys).distinct().alias("s"), same, "left_anti")
    return kept.unionByName(stage.select(*target.columns))


def upsert_lower(target: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """Upsert on the lower-cased key."""
    keyed = lambda df: df.withColumn("_k", F.lower(key))
    return upsert(keyed(target), keyed(stage), ["_k"]).drop("_k")


def by_encounter(rows: DataFrame, encounters: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with the written encounters. Where they are too many to broadcast, a task hashes its part of them; to sort would hold all its rows as well."""
    written = encounters.select("encounter_id").distinct()
    most = written.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return rows.join(written if size <= most else written.hint("shuffle_hash"), "encounter_id", how)


def swept_upsert(target: DataFrame, stage: DataFrame, encounters: DataFrame) -> DataFrame:
    """Merge then delete orphans of the written encounters: children embed their encounter, so both are one anti join."""
    return by_encounter(target, encounters, "left_anti").unionByName(stage.select(*target.columns))


def with_visit_ordinals(encounters: DataFrame) -> DataFrame:
    w = Window.partitionBy("patient_id").orderBy("encounter_date", "encounter_id")
    return encounters.withColumn("encounter_seq", F.row_number().over(w).cast("long"))


def with_drug_class(prescriptions: DataFrame, reference: DataFrame) -> DataFrame:
    """Class by case-insensitive name; unmatched rows keep theirs. The lookup side is made unique first."""
    ref = reference.groupBy(F.lower("drug_name").alias("_name")).agg(F.min("drug_class").alias("_class"))
    joined = prescriptions.join(ref, F.lower("drug_name") == F.col("_name"), "left")
    return joined.withColumn("drug_class", F.coalesce("_class", "drug_class")).select(*prescriptions.columns)


def with_seen_dates(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    seen = encounters.groupBy("patient_id").agg(F.min("encounter_date").alias("_first"), F.max("encounter_date").alias("_last"))
    joined = patients.join(seen, "patient_id", "left")
    return joined.withColumn("first_seen_date", F.coalesce("_first", "first_seen_date")).withColumn("last_seen_date", F.coalesce("_last", "last_seen_date")).select(*patients.columns)


#: The refreshes of derived columns in the order they run: table, what it reads, how.
REFRESHES = [
    ("encounters", (), with_visit_ordinals),
    ("prescriptions", ("ref_drug_class",), with_drug_class),
    ("patients", ("encounters",), with_seen_dates),
]
AUDIT = "ingest_runs"


class Warehouse:
    """Tables under `root`, read and written through Spark only.

    A version is a marker that names the folder of each table; a write adds folders for the
    tables it changes and a marker that keeps the others'. The audit table lies beside the
    versions: an append to it is no version.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        markers = path(f"{self.root}/versions")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(markers)) if fs.exists(markers) else []

    def folders(self, version: int | None = None) -> dict[str, str]:
        """The folder of each table in a version, the newest where none is given."""
        known = self.versions()
        at = version if version is not None else (known[-1] if known else None)
        if at is None:
            return {}
        rows = self.spark.read.text(f"{self.root}/versions/{at}").collect()
        return dict(r["value"].split("=", 1) for r in rows)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        folder = f"{self.root}/runs" if table == AUDIT else self.folders(version).get(table)
        fs, path = self._fs()
        if folder is None or not fs.exists(path(folder)):
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(folder)

    def publish(self, tables: dict[str, DataFrame]) -> int:
        """Write the given tables and then the marker of a version that has them; the others stay as they are."""
        known = self.versions()
        version = known[-1] + 1 if known else 1
        folders = self.folders()
        for name, rows in tables.items():
            if name != AUDIT:
                folders[name] = f"{self.root}/data/{name}/{version}-{uuid.uuid4().hex}"
                rows.select(*SCHEMAS[name].fieldNames()).write.parquet(folders[name])
        return self.mark(version, folders)

    def mark(self, version: int, folders: dict[str, str]) -> int:
        fs, path = self._fs()
        out = fs.create(path(f"{self.root}/versions/{version}"), False)
        out.write(bytearray("\n".join(f"{k}={v}" for k, v in sorted(folders.items())).encode()))
        out.close()
        return version

    def restore(self, version: int) -> int:
        """An older version's tables as the newest version: a marker, and no copy."""
        return self.mark(self.versions()[-1] + 1, self.folders(version))

    def clear(self, document: str) -> int:
        """A version without a document: its row and all rows that came from it. Audit rows and issues stay."""
        left = {}
        for name in SCHEMAS:
            key = next((c for c in ("source_document_id", "document_id") if c in SCHEMAS[name].fieldNames()), None)
            if key and name not in (AUDIT, "ingestion_issues"):
                rows = self.read(name)
                left[name] = rows.where(~F.col(key).eqNullSafe(F.lit(document)))
        return self.publish(self.refreshed(left))

    def verify(self, version: int, without: tuple[str, ...] = ("ingested_at", "created_at", "ingest_run_id")) -> list[str]:
        """Tables whose rows now differ from a version's."""
        state = lambda name, at: tuple(fingerprint(self.read(name, at), without).first())
        return [n for n in SCHEMAS if n != AUDIT and state(n, None) != state(n, version)]

    def rearm(self, document: str) -> dict[str, int]:
        """Clear a document so that it can be ingested again; the rows of it that are left in each table, which must be none."""
        self.clear(document)
        count = lambda name, key: self.read(name).where(F.col(key) == document).count()
        keys = {n: next((c for c in ("source_document_id", "document_id") if c in SCHEMAS[n].fieldNames()), None) for n in SCHEMAS if n not in (AUDIT, "ingestion_issues")}
        return {n: count(n, key) for n, key in keys.items() if key}

    def vacuum(self, keep: int) -> int:
        """Remove all but the newest `keep` versions and the folders that only they name; how many folders went."""
        fs, path = self._fs()
        known = self.versions()
        old, new = known[: -keep or None], known[-keep:] if keep else []
        needed = {f for v in new for f in self.folders(v).values()}
        gone = {f for v in old for f in self.folders(v).values()} - needed
        for v in old:
            fs.delete(path(f"{self.root}/versions/{v}"), False)
        for folder in gone:
            fs.delete(path(folder), True)
        return len(gone)

    def refreshed(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The given tables, and those whose derived columns they change."""
        out = dict(tables)
        get = lambda name: out[name] if name in out else self.read(name)
        for name, reads, refresh in REFRESHES:
            if name in out or any(r in out for r in reads):
                out[name] = refresh(get(name), *[get(r) for r in reads])
        return out

    def merged(self, bundle: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The changed tables after a write of `bundle`; of rows with one key the last by `_ord`, where the bundle has it, else by all columns, stays."""
        out: dict[str, DataFrame] = {}
        given = bundle.get("encounters")
        for name, rows in bundle.items():
            order = F.col("_ord") if "_ord" in rows.columns else F.struct(*[c for c in rows.columns])
            stage = last_wins(rows, list(MERGE_KEYS[name]), order).drop("_ord")
            target = self.read(name)
            out[name] = swept_upsert(target, stage, given) if name in SWEPT and given is not None else upsert(target, stage, list(MERGE_KEYS[name]))
        if given is not None:
            for name in SWEPT:
                if name not in bundle:
                    out[name] = by_encounter(self.read(name), given, "left_anti")
        return self.refreshed(out)

    def write(self, bundle: dict[str, DataFrame]) -> int:
        return self.publish(self.merged(bundle))

    def effects(self, old: int | None, new: int) -> DataFrame:
        """(name, inserted, updated, deleted) of each table between two versions."""
        parts = []
        for name in SCHEMAS:
            if name != AUDIT:
                before = self.read(name, old) if old is not None else self.spark.createDataFrame([], SCHEMAS[name])
                parts.append(changes(before, self.read(name, new), list(MERGE_KEYS[name])).withColumn("name", F.lit(name)))
        return reduce(DataFrame.unionByName, parts).select("name", "inserted", "updated", "deleted")

    def record_run(self, row: dict) -> bool:
        """Append an audit row; a failure never masks the run's outcome."""
        return self.record_runs(self.spark.createDataFrame([{f: row.get(f) for f in SCHEMAS[AUDIT].fieldNames()} | {"run_id": row.get("run_id") or uuid.uuid4().hex}], SCHEMAS[AUDIT]))

    def record_runs(self, rows: DataFrame) -> bool:
        try:
            rows.select(*SCHEMAS[AUDIT].fieldNames()).write.mode("append").parquet(f"{self.root}/runs")
            return True
        except Exception:  # noqa: BLE001
            return False


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(ord, name, rows) of each table."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(i).alias("ord"), F.lit(name).alias("name"), "rows") for i, (name, df) in enumerate(tables.items())]
    return reduce(DataFrame.unionByName, parts).orderBy("ord")


def changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """inserted, updated and deleted rows by key, in one row."""
    a, b = (df.select(*keys, row_text(df.columns).alias("_row")).alias(n) for df, n in ((before, "a"), (after, "b")))
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = a.join(b, same, "full")
    return both.agg(F.count_if(F.col("a._row").isNull()).alias("inserted"), F.count_if(F.col("a._row") != F.col("b._row")).alias("updated"), F.count_if(F.col("b._row").isNull()).alias("deleted"))


def row_text(columns: list[str]) -> Column:
    """All values of a row in one text: a NULL as a dash, any other behind a colon."""
    value = lambda c: F.coalesce(F.concat(F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.array_join(F.array(*[value(c) for c in columns]), "\u001f")


def fingerprint(df: DataFrame, without: tuple[str, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """Order-independent digest of the rows (of each group): the sums of two halves of each row's hash and the count, hashed. Sums, so that no task holds all hashes."""
    row = F.md5(row_text(sorted(c for c in df.columns if c not in without)).cast("binary"))
    half = lambda at: F.sum(F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(38,0)"))
    summed = df.groupBy(*by).agg(half(1).alias("_a"), half(16).alias("_b"), F.count("*").alias("rows"))
    text = F.concat_ws("|", F.coalesce("_a", F.lit(0)).cast("string"), F.coalesce("_b", F.lit(0)).cast("string"), F.col("rows").cast("string"))
    return summed.select(*by, F.md5(text.cast("binary")).alias("fingerprint"), "rows")
