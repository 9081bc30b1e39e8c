import datetime
import json

import pytest
from pyspark.sql import functions as F

from chartloom.operators import classify, score, serve, validate
from chartloom.sources import files


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('views')}/v"
    made = spark.createDataFrame([("p1", datetime.date(2025, 7, 2), [("a", 1)])], "mrn string, encounter_date date, items array<struct<k: string, n: int>>")
    made.write.parquet(path)
    view = spark.read.parquet(path)
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("base_table")
    spark.sql("CREATE TABLE IF NOT EXISTS saved USING parquet AS SELECT 1 AS x")
    return serve.serving_session(spark, {"v_encounter_summary": view, "v_patient_timeline": view})


@pytest.mark.parametrize("query", [
    "SELECT mrn FROM v_encounter_summary", "WITH a AS (SELECT * FROM v_patient_timeline) SELECT * FROM a;", "SELECT ';' AS s FROM v_encounter_summary LIMIT 5",
    "SELECT x.k FROM v_encounter_summary t, UNNEST(t.items) x", "WITH a AS (SELECT mrn FROM v_encounter_summary), b AS (SELECT * FROM a) SELECT count(*), max(mrn) FROM b WHERE mrn IN (SELECT mrn FROM a) AND EXISTS (SELECT 1 FROM b)",
    "SELECT CASE WHEN mrn LIKE 'p%' THEN upper(mrn) END AS m, row_number() OVER (ORDER BY mrn) AS n FROM v_encounter_summary UNION ALL SELECT mrn, 1 FROM v_patient_timeline ORDER BY 1 LIMIT 3 OFFSET 1", "SELECT transform(items, x -> x.n + 1) AS t, cast(mrn AS STRING) FROM v_encounter_summary WHERE mrn BETWEEN 'a' AND 'z' AND size(items) > 0",
    "SELECT count(DISTINCT mrn) FILTER (WHERE mrn IS NOT NULL) AS n FROM v_encounter_summary HAVING count(*) > 0", "SELECT extract(MONTH FROM encounter_date) AS m FROM v_encounter_summary GROUP BY 1",
])
def test_accepted(served, query):
    assert serve.run_sql(served, query)["status"] == "ok"


@pytest.mark.parametrize("query", [
    "", "DROP TABLE v_encounter_summary", "INSERT INTO v_encounter_summary SELECT 1", "SELECT 1", "SELECT * FROM base_table", "SELECT * FROM other.v_encounter_summary", "SELECT 1 FROM v_encounter_summary; SELECT 2 FROM v_encounter_summary",
    "SELECT * FROM v_encounter_summary, base_table", "SELECT * FROM v_encounter_summary WHERE EXISTS (SELECT 1 FROM base_table)", "SELECT * FROM v_encounter_summary WHERE mrn IN (SELECT x FROM base_table)", "WITH a AS (SELECT * FROM base_table) SELECT * FROM a", "SELECT (SELECT max(x) FROM base_table) AS m FROM v_encounter_summary",
    "SELECT * FROM _staging", "SELECT * FROM parquet.`/tmp/x`", "CREATE TABLE t AS SELECT 1", "DELETE FROM v_encounter_summary", "CALL f()",
    "WITH base_table AS (SELECT * FROM base_table) SELECT * FROM base_table", "WITH saved AS (SELECT * FROM saved) SELECT * FROM saved", "WITH a AS (SELECT * FROM later), later AS (SELECT 1 AS x FROM v_encounter_summary) SELECT * FROM a",
    "WITH v_encounter_summary AS (SELECT * FROM base_table) SELECT * FROM v_encounter_summary", "SELECT (SELECT max(x) FROM base_table) FROM v_encounter_summary", "SELECT * FROM (WITH base_table AS (SELECT 1 AS x) SELECT * FROM base_table) q, base_table, v_encounter_summary",
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM v_encounter_summary", "SELECT reflect('java.lang.Runtime', 'getRuntime') FROM v_encounter_summary", "SELECT * FROM v_encounter_summary WHERE java_method('a.B', 'c') = 1",
    "SELECT upper(reflect('a.B', 'c')) AS x FROM v_encounter_summary ORDER BY 1", "SELECT * FROM v_encounter_summary JOIN range(10)", "SELECT current_user() FROM v_encounter_summary", "SELECT count(*) FROM v_encounter_summary GROUP BY try_reflect('a.B', 'c')",
    "SELECT 1 WHERE 1 IN (SELECT x FROM saved)", "SELECT * FROM spark_catalog.default.saved", "WITH RECURSIVE r AS (SELECT 1 AS n FROM v_encounter_summary UNION ALL SELECT n + 1 FROM r) SELECT * FROM r",
    "SELECT * FROM v_encounter_summary WHERE mrn = (SELECT first(x) FROM saved)", "SELECT max(x) OVER (PARTITION BY (SELECT 1 FROM saved)) FROM v_encounter_summary",
])
def test_refused(served, query):
    assert serve.run_sql(served, query)["status"] == "refused"


def test_results_are_json_safe_capped_and_errors_do_not_raise(served):
    assert serve.run_sql(served, "SELECT * FROM v_encounter_summary")["rows"] == [{"mrn": "p1", "encounter_date": "2025-07-02", "items": [{"k": "a", "n": 1}]}]
    assert serve.run_sql(served, "SELECT nothing FROM v_encounter_summary")["status"] == "error"
    assert serve.run_sql(served, "SELECT * FROM v_encounter_summary", most_bytes=0)["status"] == "refused"
    assert ("items.k", "string", "NULLABLE", "") in serve.described(served.table("v_encounter_summary").schema)


def test_tables_of_other_sessions_are_out_of_reach(served):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        served.sql("SELECT * FROM saved").collect()


def test_values_of_every_type_become_json(spark):
    row = spark.range(1).selectExpr("CAST(1.5 AS DECIMAL(5,2)) AS d", "DATE '2025-01-02' AS day", "TIMESTAMP '2025-01-02 03:04:05' AS t", "CAST('ab' AS BINARY) AS b", "map('k', DATE '2025-01-02') AS m", "array(named_struct('x', CAST(NULL AS DATE)), NULL) AS a", "CAST(NULL AS STRING) AS n", "array(1, NULL) AS i")
    assert json.loads(json.dumps(serve.rows_of(row))) == [{"d": 1.5, "day": "2025-01-02", "t": "2025-01-02T03:04:05", "b": "ab", "m": {"k": "2025-01-02"}, "a": [{"x": None}, None], "n": None, "i": [1, None]}]


def test_validation_and_status(spark):
    rows = spark.createDataFrame([("e1", 120, 80), ("e2", 900, 80), (None, 120, 5)], "encounter_id string, bp_systolic int, bp_diastolic int")
    for c in ("pulse", "respirations", "o2_sat", "temperature_f", "height_in", "weight_lbs", "bmi", "bsa"):
        rows = rows.withColumn(c, F.lit(None).cast("double"))
    good, bad = validate.checked(rows, "vitals")
    assert good.count() == 1
    assert sorted(tuple(r["broken"]) for r in bad.collect()) == [("bp_systolic",), ("encounter_id", "bp_diastolic")]
    issues = validate.issues(bad.withColumn("d", F.lit("doc")), F.col("d"), F.lit(None).cast("date"))
    assert issues.count() == 3
    docs = spark.createDataFrame([("doc",), ("fine",), ("empty",)], "document_id string")
    visits = spark.createDataFrame([("doc",), ("fine",)], "source_document_id string")
    assert dict(tuple(r) for r in validate.parse_status(docs, visits, issues).select("document_id", "parse_status").collect()) == {"doc": "partial", "fine": "ok", "empty": "failed"}
    assert validate.missing(spark.createDataFrame([("v",)], "k string"), ["a", "b"], spark.createDataFrame([("v", "a")], "k string, section string"), ["k"]).collect()[0]["section"] == "b"


def test_classifier_replies(spark):
    visits = spark.createDataFrame([("good",), ("low",), ("raise",), ("text",), ("",)], "text string")

    def model(text):
        if text == "raise":
            raise RuntimeError
        return {"good": '{"laterality": "left", "visit_type": "odd", "body_region": "none", "confidence": 0.9}', "low": '{"laterality": "left", "confidence": 0.1}', "text": "no json"}[text]

    got = {r["text"]: (r["laterality"], r["visit_type"], r["body_region"], r["classify_error"]) for r in classify.classified(visits, "text", model).collect()}
    assert got == {"good": ("left", None, None, None), "low": (None,) * 4, "raise": (None, None, None, "RuntimeError"), "text": (None, None, None, "JSONDecodeError"), "": (None,) * 4}
    assert classify.classified(visits, "text").where("laterality IS NULL").count() == 5


def test_accuracy(spark):
    truth = spark.createDataFrame([("a", "Hand/Wrist", "2.0"), ("b", "knee", "3")], "k string, body_region string, n string")
    found = spark.createDataFrame([("a", "wrist", "2"), ("b", "hip", None)], "k string, body_region string, n string")
    rows = score.compared(truth, found, ["k"], ["body_region", "n"])
    assert {r["field"]: (r["correct"], r["total"]) for r in score.accuracy(rows).collect()} == {"body_region": (1, 2), "n": (1, 2)}
    assert "| n | deterministic | 1 | 2 | 50.0% |" in score.report(rows)
    assert score.spurious(found.unionByName(found), truth, ["k"], "rows").count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "A.PDF").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    assert [r["file_name"] for r in files.documents(spark, f"file://{tmp_path}").collect()] == ["A.PDF"]
    rows = spark.createDataFrame([('{"type": "finalized", "data": {"bucket": "b", "name": "x.PDF"}}', ""), ('{"bucket": "b", "name": "y.pdf"}', "object.finalized"), ("broken", "finalized"), ('{"name": "z.txt"}', "finalized")], "body string, type string")
    assert [r["accepted"] for r in files.events(rows).collect()] == [True, True, False, False]
    with pytest.raises(ValueError, match="CHART_WAREHOUSE, CHART_INBOX"):
        files.Settings.read(env={})
