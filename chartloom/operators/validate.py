"""Declarative row rules: valid rows, rejects, issues, parse status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.keys import issue_key

CODE = r"^[A-Z]\d{2}(\.\d{1,4})?$"


def between(c: str, low: float, high: float | None = None) -> Column:
    x = F.col(c)
    return x.isNull() | ((x >= low) & (x <= high) if high is not None else x >= low)


def one_of(c: str, *values: str) -> Column:
    return F.col(c).isNull() | F.col(c).isin(*values)


def given(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) != ""


SIDES = ("left", "right", "bilateral")


def rules(table: str) -> dict[str, Column]:
    """Field -> what must hold. The closed sets and bounds."""
    return {
        "documents": {"document_id": given("document_id"), "file_bytes": between("file_bytes", 0), "page_count": between("page_count", 0), "parse_status": one_of("parse_status", "ok", "partial", "failed")},
        "patients": {"patient_id": given("patient_id"), "mrn": given("mrn"), "sex": one_of("sex", "M", "F", "O", "U")},
        "encounters": {"encounter_id": given("encounter_id"), "patient_id": given("patient_id"), "encounter_date": F.col("encounter_date").isNotNull(), "encounter_seq": between("encounter_seq", 1), "laterality": one_of("laterality", *SIDES), "visit_type": one_of("visit_type", "new", "follow_up", "post_op"), "hpi_summary": F.coalesce(F.length("hpi_summary"), F.lit(0)) <= 1000, "llm_confidence": between("llm_confidence", 0, 1), "follow_up_interval_days": between("follow_up_interval_days", 0, 3650)},
        "vitals": {"encounter_id": given("encounter_id"), "bp_systolic": between("bp_systolic", 40, 300), "bp_diastolic": between("bp_diastolic", 20, 200), "pulse": between("pulse", 20, 250), "respirations": between("respirations", 4, 80), "o2_sat": between("o2_sat", 50, 100), "temperature_f": between("temperature_f", 90, 110), "height_in": between("height_in", 20, 100), "weight_lbs": between("weight_lbs", 20, 800), "bmi": between("bmi", 5, 100), "bsa": between("bsa", 0.3, 4)},
        "diagnoses": {"diagnosis_id": given("diagnosis_id"), "icd10_code": F.col("icd10_code").isNull() | F.col("icd10_code").rlike(CODE), "laterality": one_of("laterality", *SIDES)},
        "prescriptions": {"prescription_id": given("prescription_id"), "drug_name": given("drug_name"), "quantity": between("quantity", 0), "refills": between("refills", 0, 99), "duration_days": between("duration_days", 0, 3650), "action": one_of("action", "new", "modify", "continue")},
        "imaging_studies": {"imaging_id": given("imaging_id"), "laterality": one_of("laterality", *SIDES)},
        "procedures": {"procedure_id": given("procedure_id"), "procedure_name": given("procedure_name"), "laterality": one_of("laterality", *SIDES)},
        "medication_snapshots": {"encounter_id": given("encounter_id"), "medication_name": given("medication_name")},
        "exam_findings": {"finding_id": given("finding_id"), "laterality": one_of("laterality", *SIDES), "finding_type": one_of("finding_type", "rom_active", "rom_passive", "strength", "special_test", "inspection", "skin", "stability", "narrative")},
        "patient_history": {"history_id": given("history_id"), "patient_id": given("patient_id"), "item_text": given("item_text")},
        "ingestion_issues": {"issue_id": given("issue_id"), "severity": one_of("severity", "warn", "error")},
    }.get(table, {})


def checked(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with a `broken` array of fields); one bad row never touches its siblings."""
    return split(rows, rules(table))


def split(rows: DataFrame, found: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows by whether they keep all rules (field -> what must hold); one pass marks them."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(field)) for field, ok in found.items()]), lambda x: x.isNotNull())
    marked = rows.withColumn("broken", broken if found else F.array().cast("array<string>"))
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def without_rejected_parents(children: DataFrame, rejected: DataFrame) -> DataFrame:
    return children.join(rejected.select("encounter_id").distinct(), "encounter_id", "left_anti")


def issues(rejects: DataFrame, document: Column, day: Column, severity: str = "error", kind: str = "invalid_row", scope: Column | None = None) -> DataFrame:
    """A row per broken field, keyed by patient (or document) and day."""
    rows = rejects.select(document.alias("document_id"), day.alias("_day"), F.coalesce(scope if scope is not None else F.lit(None), document).alias("_scope"), F.explode("broken").alias("field_name"))
    return rows.select(issue_key(F.col("_scope"), F.col("_day"), F.lit(kind), F.col("field_name")).alias("issue_id"), "document_id", F.lit(severity).alias("severity"), F.lit(kind).alias("issue_type"), "field_name")


def missing(expected: DataFrame, names: list[str], present: DataFrame, key: list[str], column: str = "section") -> DataFrame:
    """Sections that a visit should have and has not."""
    wanted = expected.select(*key, F.explode(F.array(*[F.lit(n) for n in names])).alias(column))
    return wanted.join(present.select(*key, column).distinct(), [*key, column], "left_anti")


def parse_status(documents: DataFrame, encounters: DataFrame, found: DataFrame) -> DataFrame:
    """failed without encounters, partial with an error, else ok."""
    n = encounters.groupBy(F.col("source_document_id").alias("document_id")).agg(F.count("*").alias("_n"))
    bad = found.groupBy("document_id").agg(F.max(F.col("severity") == "error").alias("_bad"))
    joined = documents.drop("parse_status").join(n, "document_id", "left").join(bad, "document_id", "left")
    status = F.when(F.coalesce("_n", F.lit(0)) == 0, "failed").when(F.coalesce("_bad", F.lit(False)), "partial").otherwise("ok")
    return joined.withColumn("parse_status", status).drop("_n", "_bad")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
