"""The relational operators over the driver's tables, each with its oracle.

customer stands for patient, orders for encounter, lineitem for child facts, part for the
lookup, supplier for provider, events for notifications and run audit. A query maps these
tables to the columns an operator takes, runs that operator, and maps its columns back.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.functions import keys
from chartloom.functions.keys import hash_key, normalised
from chartloom.operators import facts, geometry, score, segment, serve, store, validate
from chartloom.plans import views
from chartloom.schemas import SCHEMAS
from chartloom.sources.scratch import Scratch
from chartloom.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CODEC = "spark.sql.parquet.compression.codec"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations"


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(oracle: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def sql_query(name: str, text: str, oracle: str | None = None) -> None:
    """A query whose SQL both engines understand, or with a spelling of its own for the oracle."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        used = [t for t in TABLES.split() if re.search(rf"\b{t}\b", text)]
        return spark.sql(re.sub(rf"\b({'|'.join(used)})\b(?!\.)", r"{\1}", text), **{t: read(spark, d, t) for t in used})

    QUERIES[name] = run
    ORACLES[name] = oracle or text


def packing(spark: SparkSession) -> SparkSession:
    """A session like the caller's that writes Parquet by Zstandard: hexadecimal digests take half the bytes, where Snappy leaves them whole. A codec that the caller has set stays."""
    if CODEC in spark.conf.getAll:
        return spark
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set(CODEC, "zstd")
    return own


def primary_line() -> Column:
    return F.struct(views.flagged_first(F.col("l_returnflag") == "R"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def charted(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The driver's tables as the warehouse's: every line of an order is a diagnosis and a study; by its flag it was also prescribed or taken on arrival; large ones are procedures."""
    c = F.col
    text = lambda name: c(name).cast("string")
    kinds = read(spark, d, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    lines = read(spark, d, "lineitem").join(kinds, c("l_partkey") == c("p_partkey"), "left").withColumns({
        "encounter_id": text("l_orderkey"), "_id": F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey"), "performed_date": F.to_date("l_shipdate"),
    })
    made = {
        "patients": read(spark, d, "customer").select(text("c_custkey").alias("patient_id"), text("c_custkey").alias("mrn"), c("c_name").alias("legal_name"), c("c_mktsegment").alias("family_name")),
        "encounters": read(spark, d, "orders").select(text("o_orderkey").alias("encounter_id"), text("o_custkey").alias("patient_id"), F.to_date("o_orderdate").alias("encounter_date"), c("o_orderpriority").alias("body_region"), c("o_orderstatus").alias("visit_type")),
        "diagnoses": lines.select("encounter_id", c("_id").alias("diagnosis_id"), text("l_partkey").alias("icd10_code"), c("p_type").alias("diagnosis_text"), (c("l_returnflag") == "R").alias("is_primary"), F.when(c("p_size") > 25, c("p_brand")).alias("body_region")),
        "prescriptions": lines.where("l_returnflag = 'A'").select("encounter_id", c("_id").alias("prescription_id"), F.upper("p_type").alias("drug_name"), c("l_quantity").alias("quantity")),
        "medication_snapshots": lines.where("l_returnflag = 'N'").select("encounter_id", F.initcap("p_type").alias("medication_name")),
        "imaging_studies": lines.select("encounter_id", c("_id").alias("imaging_id"), c("p_brand").alias("modality"), "performed_date"),
        "procedures": lines.where("l_quantity > 45").select("encounter_id", c("_id").alias("procedure_id"), c("p_type").alias("procedure_name"), "performed_date"),
        "ref_drug_class": kinds.where("p_size > 45").select(c("p_type").alias("drug_name"), F.lit(True).alias("is_anti_inflammatory")),
    }
    full = lambda df, schema: df.select(*[(c(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    return {name: full(made[name], SCHEMAS[name]) if name in made else spark.createDataFrame([], SCHEMAS[name]) for name in SCHEMAS}


@query("""
WITH l AS (SELECT lineitem.*, p_type, p_brand, p_size, l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
ref AS (SELECT DISTINCT lower(p_type) AS k FROM part WHERE p_size > 45),
dx AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, id) = 1),
n AS (SELECT l_orderkey AS k, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'A') AS rx, count(*) FILTER (WHERE l_returnflag = 'N') AS meds, count(*) FILTER (WHERE l_quantity > 45) AS large,
  count(*) FILTER (WHERE l_returnflag = 'A' AND lower(p_type) IN (FROM ref)) > 0 AS written, count(*) FILTER (WHERE l_returnflag = 'N' AND lower(p_type) IN (FROM ref)) > 0 AS arrival FROM l GROUP BY 1)
SELECT o_orderkey::VARCHAR AS encounter_id, c_custkey::VARCHAR AS mrn, c_name AS legal_name, dx.l_partkey::VARCHAR AS primary_icd10_code, dx.p_type AS primary_diagnosis,
  CASE WHEN dx.p_size > 25 THEN dx.p_brand END AS primary_body_region, coalesce(CASE WHEN dx.p_size > 25 THEN dx.p_brand END, o_orderpriority) AS body_region_effective,
  coalesce(lines, 0) AS diagnosis_count, coalesce(rx, 0) AS prescription_count, coalesce(lines, 0) AS imaging_count, coalesce(large, 0) AS procedure_count, coalesce(meds, 0) AS medications_on_arrival_count,
  coalesce(arrival, false) AS anti_inflammatory_on_arrival, coalesce(written, false) AS anti_inflammatory_prescribed, coalesce(arrival OR written, false) AS anti_inflammatory_active,
  EXISTS (SELECT 1 FROM lineitem s WHERE s.l_orderkey = o_orderkey AND s.l_shipdate::DATE = o_orderdate::DATE) AS imaging_same_day
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN dx ON dx.l_orderkey = o_orderkey LEFT JOIN n ON n.k = o_orderkey""")
def encounter_summary(spark: SparkSession, d: str) -> DataFrame:
    """Q9, through the shipped view: children aggregated once by parent, flags and counts from these aggregates."""
    shown = ["encounter_id", "mrn", "legal_name", "primary_icd10_code", "primary_diagnosis", "primary_body_region", "body_region_effective", *[c for c in views.SUMMARY if c.endswith("_count")], "anti_inflammatory_on_arrival", "anti_inflammatory_prescribed", "anti_inflammatory_active", "imaging_same_day"]
    return views.encounter_summary(charted(spark, d)).select(*shown)


@query("""
WITH l AS (SELECT lineitem.*, p_type, p_brand, p_size, l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
ref AS (SELECT DISTINCT lower(p_type) AS k FROM part WHERE p_size > 45),
a AS (SELECT l_orderkey AS k, count(*) AS n, string_agg(coalesce(p_type, '?') || CASE WHEN l_returnflag = 'R' THEN '!' ELSE '' END, '|' ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, id) AS dx,
  string_agg(upper(p_type) || CASE WHEN lower(p_type) IN (FROM ref) THEN '+' ELSE '' END, '|' ORDER BY id) FILTER (WHERE l_returnflag = 'A') AS rx,
  string_agg(p_type, '|' ORDER BY l_shipdate::DATE, id) FILTER (WHERE l_quantity > 45) AS proc FROM l GROUP BY 1)
SELECT o_orderkey::VARCHAR AS encounter_id, count(*) OVER (PARTITION BY o_custkey) AS encounter_count, coalesce(n, 0) AS n_diagnoses, coalesce(dx, '') AS diagnoses, coalesce(rx, '') AS prescriptions, coalesce(proc, '') AS procedures, true AS no_vitals
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN a ON a.k = o_orderkey""")
def timeline_nested(spark: SparkSession, d: str) -> DataFrame:
    """Q10, A4, A5, J2, through the shipped view: children as sorted arrays, empty where there are none, then flattened to text."""
    t = views.patient_timeline(charted(spark, d))
    flat = lambda array, text: F.array_join(F.transform(array, text), "|")
    dx = flat("diagnoses", lambda x: F.concat(F.coalesce(x["diagnosis_text"], F.lit("?")), F.when(x["is_primary"], "!").otherwise("")))
    rx = flat("prescriptions_written", lambda x: F.concat(x["drug_name"], F.when(x["is_anti_inflammatory"], "+").otherwise("")))
    return t.select("encounter_id", "encounter_count", F.size("diagnoses").cast("long").alias("n_diagnoses"), dx.alias("diagnoses"), rx.alias("prescriptions"), flat("procedures", lambda x: x["procedure_name"]).alias("procedures"), F.col("vitals").isNull().alias("no_vitals"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity > 30")
def timeline_unnest(spark: SparkSession, d: str) -> DataFrame:
    """An array's own elements joined back to its row."""
    nested = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")).alias("a"))
    return nested.select("l_orderkey", F.inline("a")).where("l_quantity > 30").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS empty_arrays, 0::BIGINT AS null_arrays FROM orders")
def empty_array_not_null(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("a"))
    joined = read(spark, d, "orders").select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("a", F.coalesce("a", F.array().cast("array<int>")))
    return joined.agg(F.count_if(F.size("a") == 0).alias("empty_arrays"), F.count_if(F.col("a").isNull()).alias("null_arrays"))


@query("SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1")
def primary_child(spark: SparkSession, d: str) -> DataFrame:
    """The first struct in order, as an aggregate."""
    best = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min_by(F.struct("l_partkey", "l_returnflag"), primary_line()).alias("p"))
    return best.select("l_orderkey", "p.l_partkey", "p.l_returnflag")


@query("SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders")
def child_counts(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return read(spark, d, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n"))


sql_query("exists_flag", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey AND p_size > 45) AS has_large FROM orders")
sql_query("exists_or_flag", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.09) OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_tax > 0.07) AS flagged FROM orders")
sql_query("same_day_child", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE))")
sql_query("patient_inner_join", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 1000")


@query("SELECT p_partkey, coalesce(f.flagged, false) AS flagged FROM part LEFT JOIN (SELECT DISTINCT lower(p_type) AS k, true AS flagged FROM part WHERE p_size > 40) f ON lower(p_type) = f.k")
def lookup_case_insensitive(spark: SparkSession, d: str) -> DataFrame:
    """Left lookup on lower-cased names, made unique so it cannot fan out; missing means false."""
    part = read(spark, d, "part")
    ref = part.where("p_size > 40").select(F.upper("p_type").alias("name"), F.lit(True).alias("flagged"))
    return views.flag_lookup(part.select("p_partkey", "p_type"), "p_type", ref, "name", "flagged").select("p_partkey", "flagged")


@query("SELECT DISTINCT c_custkey, c_name FROM customer WHERE lower(coalesce(c_name, '')) LIKE concat('%', lower('#00000001'), '%') OR lower(coalesce(c_mktsegment, '')) LIKE concat('%', lower('BUILD'), '%') OR CAST(c_custkey AS VARCHAR) = '#00000001' ORDER BY c_custkey LIMIT 25")
def patient_search(spark: SparkSession, d: str) -> DataFrame:
    """Substring on nullable names or an exact id."""
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    found = serve.search(rows, "#00000001", ["c_name", "c_mktsegment"], "c_custkey", term_of={"c_mktsegment": "BUILD"})
    return found.select("c_custkey", "c_name")


sql_query("strpos_filter", "SELECT p_partkey FROM part WHERE instr(p_name, 'an') > 0 OR instr(p_brand, '11') > 0")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS visit FROM orders")
def visit_ordinal(spark: SparkSession, d: str) -> DataFrame:
    """W5, N1, through the store's own refresh."""
    visits = read(spark, d, "orders").select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").alias("encounter_date"))
    return store.with_visit_ordinals(visits).select(F.col("encounter_id").alias("o_orderkey"), F.col("encounter_seq").alias("visit"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_attempt(spark: SparkSession, d: str) -> DataFrame:
    return store.last_wins(read(spark, d, "events"), ["user_id"], F.struct("ts", "event_id")).select("user_id", "event_id", "event_type")


@query("SELECT c_custkey, min(o_orderdate)::DATE AS first_seen, max(o_orderdate)::DATE AS last_seen FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def first_last_seen(spark: SparkSession, d: str) -> DataFrame:
    """A3, W7, through the store's refresh."""
    none = F.lit(None).cast("date")
    patients = read(spark, d, "customer").select(F.col("c_custkey").alias("patient_id"), none.alias("first_seen_date"), none.alias("last_seen_date"))
    visits = read(spark, d, "orders").select(F.col("o_custkey").alias("patient_id"), F.to_date("o_orderdate").alias("encounter_date"))
    return store.with_seen_dates(patients, visits).toDF("c_custkey", "first_seen", "last_seen")


sql_query("refresh_changed_only", "SELECT o_orderkey FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS old, nullif(o_orderstatus, 'F') AS new FROM orders) AS t WHERE old IS DISTINCT FROM new")
sql_query("coalesce_effective", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS effective FROM orders")
sql_query("count_distinct_filtered", "SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderstatus = 'F'")
sql_query("countif_null", "SELECT l_returnflag, count(CASE WHEN nullif(l_linestatus, 'O') IS NULL THEN 1 END) AS missing, count(*) AS n FROM lineitem GROUP BY l_returnflag")
sql_query("grouped_by_code_vs_text", "SELECT p_brand, count(*) AS by_code, count(DISTINCT p_type) AS texts, min(p_type) AS label FROM part GROUP BY p_brand")
sql_query("top_conditions", "SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY n DESC, p_type LIMIT 10")
sql_query("date_part_group", "SELECT CAST(extract(YEAR FROM o_orderdate) AS INT) AS y, CAST(extract(MONTH FROM o_orderdate) AS INT) AS m, count(*) AS n FROM orders GROUP BY 1, 2")
sql_query("select_except", "SELECT * EXCEPT (c_acctbal, c_name) FROM customer", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
sql_query("equality_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1000 AND 200000")
sql_query("latest_one", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")


@query("SELECT 0 AS ord, 'customer' AS name, count(*) AS rows FROM customer UNION ALL SELECT 1, 'orders', count(*) FROM orders UNION ALL SELECT 2, 'lineitem', count(*) FROM lineitem")
def union_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.counts({n: read(spark, d, n) for n in ("customer", "orders", "lineitem")})


sql_query("sweep_anti", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
sql_query("semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")


def staged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All customers, and a stage of changed ones (those in debt) and new ones (each supplier, under a number of its own)."""
    old = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    changed = read(spark, d, "customer").where("c_acctbal < 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    new = read(spark, d, "supplier").select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"))
    return old, changed.unionByName(new)


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS c_name FROM customer UNION ALL SELECT -1 - s_suppkey, s_name FROM supplier")
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    old, new = staged(spark, d)
    return store.upsert(old, new, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN nullif(c_mktsegment, 'BUILDING') ELSE c_mktsegment END AS c_mktsegment FROM customer UNION ALL SELECT -1 - s_suppkey, NULL FROM supplier")
def merge_null_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A NULL in the stage replaces a value."""
    old, new = staged(spark, d)
    return store.upsert(old, new, ["c_custkey"]).select("c_custkey", "c_mktsegment")


@query("SELECT count(*) FILTER (WHERE c_acctbal < 0 AND (c_name <> upper(c_name) OR c_mktsegment = 'BUILDING')) AS updated, (SELECT count(*) FROM supplier) AS inserted, 0::BIGINT AS deleted FROM customer")
def merge_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a write inserts, changes and removes."""
    old, new = staged(spark, d)
    return store.changes(old, store.upsert(old, new, ["c_custkey"]), ["c_custkey"])


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def dedupe_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return store.last_wins(read(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], F.col("o_orderkey"))


@query("SELECT l_orderkey AS encounter_id, l_linenumber, l_quantity AS q FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE coalesce(o_orderstatus, '') <> 'F' UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_linenumber > 1")
def sweep_after_merge(spark: SparkSession, d: str) -> DataFrame:
    """After a write of some parents, only the stage's children of those remain."""
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("encounter_id"), "l_linenumber", F.col("l_quantity").alias("q"))
    written = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("encounter_id"))
    stage = store.by_encounter(rows, written, "left_semi").where("l_linenumber > 1").withColumn("q", F.col("q") + 1)
    return store.swept_upsert(rows, stage, written)


@query("SELECT lower(n_name) AS name, CASE WHEN n_regionkey = 1 THEN 'seeded' ELSE 'kept' END AS state FROM nation")
def seed_merge_lower(spark: SparkSession, d: str) -> DataFrame:
    nation = read(spark, d, "nation")
    old = nation.select(F.col("n_name").alias("name"), F.lit("kept").alias("state"))
    new = nation.where("n_regionkey = 1").select(F.lower("n_name").alias("name"), F.lit("seeded").alias("state"))
    return store.upsert_lower(old, new, "name").select(F.lower("name").alias("name"), "state")


@query(r"SELECT o_orderkey, sha256(concat_ws(chr(31), 'encounter', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), lower(trim(regexp_replace(coalesce(o_orderpriority, ''), '\s+', ' ', 'g'))))) AS key FROM orders")
def sha_key(spark: SparkSession, d: str) -> DataFrame:
    """K1 to K3."""
    return read(packing(spark), d, "orders").select("o_orderkey", hash_key("encounter", F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd"), normalised(F.col("o_orderpriority"))).alias("key"))


KEY = "sha256(concat_ws(chr(31), {}))"


@query(f"""SELECT l_orderkey, l_linenumber, {KEY.format("'diagnosis', e, code, t")} AS diagnosis, {KEY.format("'prescription', e, t, code, ''")} AS prescription, {KEY.format("'imaging', e, code, t, day")} AS imaging, {KEY.format("'procedure', e, t, day")} AS procedure,
  {KEY.format("'exam', e, t, code, code, '', l_linenumber::VARCHAR")} AS finding, {KEY.format("'history', e, code, t")} AS history, {KEY.format("'issue', e, day, code, t")} AS issue, sha256(t) AS document, e AS patient
FROM (SELECT *, l_orderkey::VARCHAR AS e, lower(l_returnflag) AS code, lower(l_linestatus) AS t, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem)""")
def entity_keys(spark: SparkSession, d: str) -> DataFrame:
    """K3: the key of every entity."""
    day, none = F.to_date("l_shipdate"), F.lit(None).cast("string")
    e, code, t = F.col("l_orderkey").cast("string"), F.lower("l_returnflag"), F.col("l_linestatus")
    made = {
        "diagnosis": keys.diagnosis_key(e, code, t), "prescription": keys.prescription_key(e, t, code, none), "imaging": keys.imaging_key(e, code, t, day), "procedure": keys.procedure_key(e, t, day),
        "finding": keys.finding_key(e, t, code, code, none, F.col("l_linenumber")), "history": keys.history_key(e, code, t), "issue": keys.issue_key(e, day, code, t), "document": keys.document_key(F.lower(t).cast("binary")), "patient": keys.patient_key(F.concat(F.lit(" "), e, F.lit(" "))),
    }
    return read(packing(spark), d, "lineitem").select("l_orderkey", "l_linenumber", *[k.alias(n) for n, k in made.items()])


@query("""SELECT n_regionkey, md5(concat_ws('|', sum(('0x' || substr(h, 1, 15))::BIGINT)::VARCHAR, sum(('0x' || substr(h, 16, 15))::BIGINT)::VARCHAR, count(*)::VARCHAR)) AS fingerprint, count(*) AS rows
FROM (SELECT n_regionkey, md5(concat_ws(chr(31), ':' || n_name, ':' || n_nationkey, ':' || n_regionkey)) AS h FROM nation) GROUP BY n_regionkey""")
def row_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """An order-independent digest of the rows of each group."""
    return store.fingerprint(read(spark, d, "nation"), by=("n_regionkey",))


CODED = "p_name || ' (' || upper(left(p_type, 1)) || lpad(p_size::VARCHAR, 2, '0') || '.' || right(p_brand, 2) || ').'"


@query(rf"SELECT p_partkey, nullif(regexp_extract({CODED}, '(^|[^A-Za-z0-9.])([A-Z][0-9][0-9](\.[0-9]{{1,4}})?)\.*($|[^A-Za-z0-9.])', 2), '') AS code FROM part")
def regex_code_extract(spark: SparkSession, d: str) -> DataFrame:
    """The first word of the shape of a code."""
    return read(spark, d, "part").select("p_partkey", facts.code_in(F.expr(CODED.replace("::VARCHAR", "::STRING"))).alias("code"))


PREFIXES = {"PROMO": "a", "PROMO BURNISHED": "b", "STANDARD": "c", "STANDARD POLISHED": "d", "ECONOMY": "e", "S": "f"}


@query("SELECT p_partkey, (SELECT region FROM (VALUES ('PROMO', 'a'), ('PROMO BURNISHED', 'b'), ('STANDARD', 'c'), ('STANDARD POLISHED', 'd'), ('ECONOMY', 'e'), ('S', 'f')) t(prefix, region) WHERE starts_with(p_type, prefix) ORDER BY length(prefix) DESC LIMIT 1) AS region FROM part")
def longest_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Longest prefix wins; the lookup is a constant, so it is a CASE and no join."""
    return read(spark, d, "part").select("p_partkey", facts.longest_prefix(F.col("p_type"), PREFIXES).alias("region"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN CASE right(p_brand, 1) WHEN '1' THEN 'right' WHEN '2' THEN 'left' END END AS side, CASE WHEN p_size > 25 THEN 'knee' ELSE 'lumbar spine' END AS region FROM part")
def side_from_code(spark: SparkSession, d: str) -> DataFrame:
    """Only listed families have a side in their last digit."""
    code = F.concat(F.when(F.col("p_size") > 25, "M17.1").otherwise("M51.1"), F.right("p_brand", F.lit(1)))
    return read(spark, d, "part").select("p_partkey", facts.side_of_code(code).alias("side"), facts.region_of_code(code).alias("region"))


UNIT = "CASE right(p_brand, 1) WHEN '1' THEN 'day' WHEN '2' THEN 'week' WHEN '3' THEN 'month' ELSE 'year' END"
LENGTH = "CASE right(p_brand, 1) WHEN '1' THEN 1 WHEN '2' THEN 7 WHEN '3' THEN 30 ELSE 365 END"


@query(f"SELECT p_partkey, p_size::BIGINT * {LENGTH} AS days, 'Follow up in ' || p_size || ' ' || {UNIT} || 's' AS phrase FROM part")
def follow_up_days(spark: SparkSession, d: str) -> DataFrame:
    """A number of units of time after words that ask for a return."""
    text = F.expr(f"'Seen ' || p_name || '. Rest 2 weeks. Follow up in ' || p_size || ' ' || {UNIT} || 's. Call if worse.'")
    return read(spark, d, "part").withColumn("f", facts.follow_up(text)).select("p_partkey", "f.days", "f.phrase")


@query(f"SELECT p_partkey, CASE WHEN right(p_brand, 1) IN ('1', '2', '3') THEN p_size::BIGINT * {LENGTH} ELSE -1 END AS days FROM part")
def duration_days(spark: SparkSession, d: str) -> DataFrame:
    """For how long, in days; years are none."""
    return read(spark, d, "part").select("p_partkey", F.coalesce(facts.duration_days(F.expr(f"'Take 1 daily x ' || p_size || ' ' || {UNIT} || 's with food'")), F.lit(-1)).alias("days"))


WHITE = r"[\s\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(rf"""SELECT doc_id, md5(nullif(trim(regexp_replace(replace(replace(replace(replace(array_to_string(list_filter(regexp_split_to_array(text, '{WHITE}'), lambda w: w <> '' AND NOT regexp_full_match(w, '[0-9]+[.)]')), ' '), ' .', '.'), ' ,', ','), ' ;', ';'), ' :', ':'), '[.]\s?[.]', '.', 'g'), ' .,;:-'), '')) AS cleaned FROM documents""")
def clean_prose(spark: SparkSession, d: str) -> DataFrame:
    """Enumerators dropped, punctuation mended."""
    return read(spark, d, "documents").select("doc_id", F.md5(facts.clean_prose(F.col("text")).cast("binary")).alias("cleaned"))


@query("SELECT event_id, CASE WHEN event_id % 13 < 12 THEN make_date(2000 + (event_id % 20)::INT, (event_id % 13)::INT + 1, 28) END AS day FROM events")
def date_parse_safe(spark: SparkSession, d: str) -> DataFrame:
    """Impossible dates become NULL."""
    text = F.concat(F.lit("on "), F.concat_ws("/", (F.col("event_id") % 13 + 1).cast("string"), F.lit("28"), (2000 + F.col("event_id") % 20).cast("string")), F.lit(", seen"))
    return read(spark, d, "events").select("event_id", segment.parsed_date(text).alias("day"))


@query("SELECT event_id, make_date(1990 + (event_id % 30)::INT, 1 + (event_id % 12)::INT, 5) AS day FROM events")
def service_dates(spark: SparkSession, d: str) -> DataFrame:
    """A labelled date of service, in words, among a birth date and others."""
    when = F.make_date(1990 + (F.col("event_id") % 30).cast("int"), 1 + (F.col("event_id") % 12).cast("int"), F.lit(5))
    text = F.concat(F.lit("DOB: 02/03/1950 printed 1/1/1980. Date of Service: "), F.date_format(when, "MMMM"), F.lit(" 5th, "), F.year(when).cast("string"), F.lit(" 3/3/2003"))
    return read(spark, d, "events").select("event_id", segment.service_date(text, F.lit(None).cast("date")).alias("day"))


@query("SELECT user_id, round_even(value / 3, 0)::BIGINT AS line, min(value) AS first_value, string_agg(event_type, ' ' ORDER BY value, event_id) AS text FROM events GROUP BY 1, 2")
def line_rows(spark: SparkSession, d: str) -> DataFrame:
    """L1, L2: rows by half-even rounding, text joined in order."""
    v = F.col("value")
    blocks = read(spark, d, "events").select("user_id", v.alias("x0"), v.alias("x1"), v.alias("y0"), v.alias("y1"), F.col("event_id").alias("ord"), F.col("event_type").alias("text"))
    return geometry.lines(blocks, ("user_id",)).select("user_id", F.col("row").alias("line"), F.col("y0").alias("first_value"), "text")


@query("""SELECT label_id, value_id FROM (SELECT a.event_id AS label_id, b.event_id AS value_id, row_number() OVER (PARTITION BY a.event_id ORDER BY b.value - a.value, b.event_id) AS rn
FROM events a JOIN events b ON a.user_id = b.user_id AND b.value > a.value AND least(a.event_id % 100 + 40, b.event_id % 100 + 40) > greatest(a.event_id % 100, b.event_id % 100) WHERE a.event_type = 'click') WHERE rn = 1""")
def overlap_pairing(spark: SparkSession, d: str) -> DataFrame:
    """Nearest cell below among those that overlap, inside one page."""
    place = F.col("event_id") % 100
    cells = read(spark, d, "events").select("user_id", F.col("event_id").alias("ord"), F.col("event_id").alias("text"), place.alias("x0"), (place + 40).alias("x1"), F.col("value").alias("y0"), "event_type")
    labels = cells.where("event_type = 'click'").select("user_id", F.col("ord").alias("label_id"), "x0", "x1", "y0")
    return geometry.value_below(labels, cells.drop("event_type"), ["user_id"]).select("label_id", F.col("value").alias("value_id"))


@query("SELECT event_id, sum(CASE WHEN gap > 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS col FROM (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) AS gap FROM events)")
def column_gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Columns by gaps between left edges."""
    return geometry.gap_sessions(read(spark, d, "events"), ["user_id"], "value", "event_id", F.lit(20), "col").select("event_id", "col")


@query("SELECT conv_id, turn AS page, (count(*) FILTER (WHERE role = 'user') OVER w - CASE WHEN first_value(role) OVER w = 'user' THEN 1 ELSE 0 END)::INT AS visit, DATE '2025-01-02' AS visit_date FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def page_group_split(spark: SparkSession, d: str) -> DataFrame:
    """G1: a counter that starts anew begins a visit."""
    pages = read(spark, d, "conversations").select("conv_id", F.col("turn").alias("page"), F.when(F.col("role") == "user", 1).otherwise(2).alias("page_label"), F.lit("2025-01-02").cast("date").alias("page_date"))
    return segment.split_visits(pages, "conv_id").withColumn("page", F.col("page").cast("long"))


@query("SELECT conv_id, turn, coalesce(last_value(CASE WHEN length(text) < 200 THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), -1) AS section FROM conversations")
def section_fill_forward(spark: SparkSession, d: str) -> DataFrame:
    """The last heading so far."""
    rows = read(spark, d, "conversations").withColumn("own", F.when(F.length("text") < 200, F.col("turn")))
    return segment.fill_forward(rows, "own", "section", Window.partitionBy("conv_id").orderBy("turn"), F.lit(-1)).select("conv_id", "turn", "section")


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type HAVING count(DISTINCT user_id) = (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'click')")
def repeat_in_all_groups(spark: SparkSession, d: str) -> DataFrame:
    """Relational division."""
    e = read(spark, d, "events")
    return geometry.in_every(e, e.where("event_type = 'click'"), [], "event_type", "user_id").withColumnRenamed("units", "users")


def line_rules() -> dict[str, Column]:
    return {"l_quantity": F.col("l_quantity") <= 45, "l_discount": F.col("l_discount") <= 0.09, "l_tax": F.col("l_tax") <= 0.07}


@query("SELECT l_orderkey, l_linenumber, f AS field FROM (SELECT l_orderkey, l_linenumber, 'l_quantity' AS f FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount' FROM lineitem WHERE l_discount > 0.09 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax' FROM lineitem WHERE l_tax > 0.07)")
def issue_rows(spark: SparkSession, d: str) -> DataFrame:
    """V1, V5: every broken rule is a row; one pass over the table."""
    _, broken = validate.split(read(spark, d, "lineitem"), line_rules())
    return broken.select("l_orderkey", "l_linenumber", F.explode("broken").alias("field"))


@query("SELECT l_orderkey, l_linenumber, NOT (l_quantity > 45 OR l_discount > 0.09 OR l_tax > 0.07) AS valid FROM lineitem")
def validation_split(spark: SparkSession, d: str) -> DataFrame:
    good, bad = validate.split(read(spark, d, "lineitem"), line_rules())
    return good.select("l_orderkey", "l_linenumber", F.lit(True).alias("valid")).unionByName(bad.select("l_orderkey", "l_linenumber", F.lit(False).alias("valid")))


@query("SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'failed' WHEN max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 'partial' ELSE 'ok' END AS status FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def parse_status(spark: SparkSession, d: str) -> DataFrame:
    """V3."""
    lines = read(spark, d, "lineitem")
    visits = lines.select(F.col("l_orderkey").alias("source_document_id"))
    found = lines.select(F.col("l_orderkey").alias("document_id"), F.when(F.col("l_returnflag") == "R", "error").otherwise("warn").alias("severity"))
    out = validate.parse_status(read(spark, d, "orders").select(F.col("o_orderkey").alias("document_id")), visits, found)
    return out.toDF("o_orderkey", "status")


@query("SELECT o_orderkey, flag FROM (SELECT o_orderkey, unnest(['A', 'N', 'R']) AS flag FROM orders) AS e WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = flag)")
def missing_sections(spark: SparkSession, d: str) -> DataFrame:
    """V4."""
    there = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("flag"))
    return validate.missing(read(spark, d, "orders").select("o_orderkey"), ["A", "N", "R"], there, ["o_orderkey"], "flag")


def graded(spark: SparkSession, d: str) -> DataFrame:
    """Labels against a guess from the length of a text."""
    guess = read(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 300, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    return score.compared(read(spark, d, "labels").select("doc_id", "quality", "toxic"), guess, ["doc_id"], ["quality", "toxic"])


GRADED = "SELECT x.doc_id, f AS field, t::VARCHAR AS truth, g::VARCHAR AS found FROM (SELECT doc_id, 'quality' AS f, quality AS t FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels) x LEFT JOIN (SELECT doc_id, 'quality' AS f, CASE WHEN n_chars > 300 THEN 1 ELSE 0 END AS g FROM documents UNION ALL SELECT doc_id, 'toxic', 0 FROM documents) y USING (doc_id, f)"


@query(f"SELECT field, 'deterministic' AS method, count(*) FILTER (WHERE coalesce(truth, '') = coalesce(found, '')) AS correct, count(*) AS total, round(count(*) FILTER (WHERE coalesce(truth, '') = coalesce(found, '')) / count(*)::DOUBLE, 6) AS accuracy FROM ({GRADED}) GROUP BY field")
def accuracy_by_field(spark: SparkSession, d: str) -> DataFrame:
    """A11, Q14."""
    return score.accuracy(graded(spark, d)).withColumn("accuracy", F.round("accuracy", 6))


@query(f"SELECT field, doc_id::VARCHAR AS key, truth, found FROM ({GRADED}) WHERE coalesce(truth, '') <> coalesce(found, '')")
def miss_list(spark: SparkSession, d: str) -> DataFrame:
    """Q12: what was wrong, one row each."""
    return score.misses(graded(spark, d))


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) AS t WHERE rn > 3")
def spurious_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows past the three that each group is expected to have."""
    expected = read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(3).alias("_n"))
    return score.beyond(read(spark, d, "lineitem"), expected, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, found, coalesce(found, '') = o_custkey::VARCHAR AS correct FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey::VARCHAR) AS found FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def truth_match(spark: SparkSession, d: str) -> DataFrame:
    """Truth against the first found row of its key."""
    truth = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("part"))
    found = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("part"))
    return score.compared(truth, found, ["o_orderkey"], ["part"]).select("o_orderkey", "found", "correct")


@query("SELECT event_type, count(*) AS users FROM (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) GROUP BY event_type")
def stream_upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream of files, each micro-batch upserted by key and published; the state at the end."""
    scratch = Scratch(spark)
    rows = spark.readStream.schema(read(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    none = {f.name: F.lit(None).cast(f.dataType) for f in SCHEMAS["patients"]}
    staged_rows = rows.withColumns(none | {"patient_id": F.col("user_id").cast("string"), "mrn": F.col("event_type"), "_ord": F.struct("ts", "event_id")}).select(*SCHEMAS["patients"].fieldNames(), "_ord")
    warehouse = store.Warehouse(spark, f"{scratch.folder}/warehouse")
    ingest.upserted(warehouse, "patients", staged_rows, f"{scratch.folder}/checkpoint", ["patient_id"], "_ord")
    return warehouse.read("patients").groupBy(F.col("mrn").alias("event_type")).agg(F.count("*").alias("users"))


def served(spark: SparkSession, d: str) -> SparkSession:
    return serve.serving_session(spark, {"v_encounter_summary": views.encounter_summary(charted(spark, d))})


@query("SELECT c_name AS legal_name, count(*) AS visits, sum(n)::BIGINT AS lines FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT o_orderkey AS k, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) ON k = o_orderkey GROUP BY c_name ORDER BY visits DESC, c_name LIMIT 20")
def guarded_sql(spark: SparkSession, d: str) -> DataFrame:
    """Q1 to Q4: a query that the guard lets through, in the serving session."""
    session = served(spark, d)
    text = serve.guarded(session, "WITH v AS (SELECT legal_name, diagnosis_count FROM v_encounter_summary) SELECT legal_name, count(*) AS visits, sum(diagnosis_count) AS lines FROM v GROUP BY legal_name ORDER BY visits DESC, legal_name LIMIT 20")
    return session.sql(text)


@query()
def schema_describe(spark: SparkSession, d: str) -> DataFrame:
    """S11, Q7."""
    t = charted(spark, d)
    rows = [(name, *row) for name, made in views.VIEWS.items() for row in serve.described(made(t).schema)]
    return spark.createDataFrame(rows, "view string, name string, type string, mode string, comment string")
