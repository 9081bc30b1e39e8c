"""The two curated views: encounter summary (one row a visit) and nested patient timeline.

Each child table is aggregated once, by encounter, and joined left: no fan-out, one shuffle
a child. The pieces are general, and the registered queries run them over other tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of each view, in order; of its nested arrays their fields.
SUMMARY = [
    "encounter_id", "patient_id", "mrn", "legal_name", "preferred_name", "given_name", "family_name", "date_of_birth", "sex", "encounter_date", "encounter_seq", "provider_name", "provider_role", "location_name",
    "chief_complaint_raw", "follow_up_interval_days", "follow_up_raw", "primary_body_region", "primary_laterality", "body_region", "laterality", "visit_type", "llm_confidence", "hpi_summary", "body_region_effective",
    "primary_icd10_code", "primary_diagnosis", "diagnosis_count", "prescription_count", "imaging_count", "procedure_count", "medications_on_arrival_count",
    "anti_inflammatory_on_arrival", "anti_inflammatory_prescribed", "anti_inflammatory_active", "imaging_same_day", "source_document_id", "source_page_start", "source_page_end",
]
TIMELINE = [
    "patient_id", "mrn", "legal_name", "preferred_name", "given_name", "family_name", "date_of_birth", "sex", "phone_home", "first_seen_date", "last_seen_date", "encounter_count", "encounter_id", "encounter_date", "encounter_seq",
    "provider_name", "provider_role", "location_name", "body_region", "laterality", "visit_type", "llm_confidence", "chief_complaint_raw", "hpi_summary", "hpi_text", "note_text", "follow_up_interval_days", "follow_up_raw", "signed_by", "signed_at",
    "patient_history", "diagnoses", "prescriptions_written", "medications_on_arrival", "imaging", "procedures", "exam_findings", "vitals", "source_document_id", "source_page_start", "source_page_end",
]
NESTED = {
    "diagnoses": ["icd10_code", "icd10_description", "diagnosis_text", "is_primary", "body_region", "laterality"],
    "prescriptions_written": ["drug_name", "strength", "strength_unit", "dose_form", "route", "sig_text", "quantity", "quantity_unit", "refills", "duration_days", "is_prn", "action", "drug_class", "is_anti_inflammatory"],
    "medications_on_arrival": ["medication_name", "strength", "strength_unit", "dose_form", "route", "is_anti_inflammatory"],
    "imaging": ["modality", "body_part", "laterality", "performed_date", "interpretation_text", "impression"],
    "procedures": ["procedure_name", "body_part", "laterality", "performed_date", "surgeon_name", "note_text"],
    "exam_findings": ["body_part", "laterality", "finding_type", "measure_name", "value_numeric", "unit", "value_text"],
    "vitals": ["taken_by", "taken_date", "bp_systolic", "bp_diastolic", "pulse", "respirations", "o2_sat", "temperature_f", "height_in", "weight_lbs", "bmi", "bsa", "is_patient_reported"],
}
COMMENTS = {
    "primary_body_region": "region of the primary diagnosis's code", "body_region": "region as classified from prose; NULL where no classifier ran", "body_region_effective": "region of the code, else of the prose; group by this",
    "medications_on_arrival": "what the patient already took when the visit began", "prescriptions_written": "what was prescribed at the visit", "patient_history": "of the patient, repeated at each visit",
    "imaging_same_day": "a study was performed on the day of the visit", "anti_inflammatory_active": "taken on arrival or prescribed at the visit",
}


def no(flag: str | Column) -> Column:
    return F.coalesce(F.col(flag) if isinstance(flag, str) else flag, F.lit(False))


def first_child(order: Sequence[Column | str], fields: Sequence[str]) -> Column:
    """The struct of the child that comes first: an aggregate, so several firsts fan nothing out."""
    return F.min_by(F.struct(*fields), F.struct(*order))


def flagged_first(flag: Column) -> Column:
    """Rank of a nullable flag: true, false, NULL."""
    return F.when(flag, 0).when(~flag, 1).otherwise(2)


def ordered(keys: Sequence[Column | str], fields: Sequence[str]) -> Column:
    """Array of structs of `fields`, sorted by keys."""
    keyed = [(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*keyed, F.struct(*fields).alias("v")))), lambda x: x["v"])


def per_parent(children: DataFrame, parent: str, **measures: Column) -> DataFrame:
    return children.groupBy(parent).agg(*[m.alias(n) for n, m in measures.items()])


def with_children(parents: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Parents and their aggregates by key; parents without children stay."""
    for part in parts:
        parents = parents.join(part, key, "left")
    return parents


def filled(rows: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Missing arrays as empty ones."""
    return rows.withColumns({a: F.coalesce(a, F.array().cast(rows.schema[a].dataType)) for a in arrays})


def flag_lookup(rows: DataFrame, name: str, reference: DataFrame, key: str, flag: str) -> DataFrame:
    """rows with the flag of a lookup by lower-cased name; the lookup is made unique, what it lacks is false."""
    ref = reference.groupBy(F.lower(key).alias("_n")).agg(F.max(flag).alias("_flag"))
    return rows.join(ref, F.lower(name) == F.col("_n"), "left").withColumn(flag, no("_flag")).drop("_n", "_flag")


def classed(rows: DataFrame, name: str, reference: DataFrame) -> DataFrame:
    return flag_lookup(rows, name, reference, "drug_name", "is_anti_inflammatory")


def described(rows: DataFrame) -> DataFrame:
    """Columns with the comments that the schema description shows."""
    return rows.select(*[F.col(c).alias(c, metadata={"comment": COMMENTS[c]}) if c in COMMENTS else F.col(c) for c in rows.columns])


def encounter_summary(t: dict[str, DataFrame]) -> DataFrame:
    n = F.count("*")
    dx = per_parent(t["diagnoses"], "encounter_id", diagnosis_count=n, dx=first_child([flagged_first(F.col("is_primary")), "diagnosis_id"], ["icd10_code", "diagnosis_text", F.col("body_region").alias("part"), F.col("laterality").alias("side")]))
    rx = per_parent(classed(t["prescriptions"], "drug_name", t["ref_drug_class"]), "encounter_id", prescription_count=n, _written=F.max("is_anti_inflammatory"))
    meds = per_parent(classed(t["medication_snapshots"], "medication_name", t["ref_drug_class"]), "encounter_id", medications_on_arrival_count=n, _arrival=F.max("is_anti_inflammatory"))
    dated = t["imaging_studies"].join(t["encounters"].select("encounter_id", "encounter_date"), "encounter_id")
    imaging = per_parent(dated, "encounter_id", imaging_count=n, _same=F.max(F.col("performed_date") == F.col("encounter_date")))
    people = t["patients"].select("patient_id", "mrn", "legal_name", "preferred_name", "given_name", "family_name", "date_of_birth", "sex")
    joined = with_children(t["encounters"].join(people, "patient_id"), "encounter_id", dx, rx, meds, imaging, per_parent(t["procedures"], "encounter_id", procedure_count=n))
    made = {
        "primary_body_region": F.col("dx.part"), "primary_laterality": F.col("dx.side"), "body_region_effective": F.coalesce("dx.part", "body_region"), "primary_icd10_code": F.col("dx.icd10_code"), "primary_diagnosis": F.col("dx.diagnosis_text"),
        "anti_inflammatory_on_arrival": no("_arrival"), "anti_inflammatory_prescribed": no("_written"), "anti_inflammatory_active": no("_arrival") | no("_written"), "imaging_same_day": no("_same"),
    } | {c: F.coalesce(c, F.lit(0)) for c in SUMMARY if c.endswith("_count")}
    return described(joined.withColumns(made).select(*SUMMARY))


def patient_timeline(t: dict[str, DataFrame]) -> DataFrame:
    """Every visit with all its children as sorted arrays; nothing recorded is an empty array, and NULL for the vitals."""
    children = {
        "diagnoses": (t["diagnoses"], [flagged_first(F.col("is_primary")), "diagnosis_id"]),
        "prescriptions_written": (classed(t["prescriptions"], "drug_name", t["ref_drug_class"]), ["prescription_id"]),
        "medications_on_arrival": (classed(t["medication_snapshots"], "medication_name", t["ref_drug_class"]), ["medication_name"]),
        "imaging": (t["imaging_studies"], ["performed_date", "imaging_id"]),
        "procedures": (t["procedures"], ["performed_date", "procedure_id"]),
        "exam_findings": (t["exam_findings"], ["finding_type", "laterality", "measure_name", "finding_id"]),
    }
    parts = [per_parent(rows, "encounter_id", **{name: ordered(keys, NESTED[name])}) for name, (rows, keys) in children.items()]
    history = per_parent(t["patient_history"], "patient_id", patient_history=ordered(["history_type", "item_text"], ["history_type", "item_text"]))
    visits = per_parent(t["encounters"], "patient_id", encounter_count=F.count("*"))
    vitals = t["vitals"].select("encounter_id", F.struct(*NESTED["vitals"]).alias("vitals"))
    people = t["patients"].select("patient_id", "mrn", "legal_name", "preferred_name", "given_name", "family_name", "date_of_birth", "sex", "phone_home", "first_seen_date", "last_seen_date")
    out = with_children(t["encounters"].join(people, "patient_id"), "patient_id", history, visits)
    out = with_children(out, "encounter_id", *parts, vitals)
    return described(filled(out, ["patient_history", *children]).select(*TIMELINE))


VIEWS = {"v_encounter_summary": encounter_summary, "v_patient_timeline": patient_timeline}
