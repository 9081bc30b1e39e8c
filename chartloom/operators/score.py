"""Field-level accuracy of extracted rows against truth, in both directions, with a list of misses."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Regions that count as equal.
EQUIVALENT = [("hand/wrist", "hand"), ("hand/wrist", "wrist"), ("foot/ankle", "foot"), ("foot/ankle", "ankle"), ("hip/pelvis", "hip"), ("hip/pelvis", "pelvis")]


def comparable(value: Column) -> Column:
    """NULL as empty, white space and case folded, whole numbers without a fraction."""
    text = F.lower(F.trim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"(?U)\s+", " ")))
    return F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")


def sex(value: Column) -> Column:
    return F.upper(F.substring(F.trim(value), 1, 1))


def laterality(value: Column) -> Column:
    return F.when(F.lower(value) == "none", F.lit("")).otherwise(value)


def long_form(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, value): one row for each field."""
    return rows.select(*keys, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(keys, fields, "field", "value")


def compared(truth: DataFrame, found: DataFrame, keys: list[str], fields: list[str], method: str = "deterministic") -> DataFrame:
    """(keys, field, method, truth, found, correct): every truth field against the first found row of its key."""
    order = Window.partitionBy(*keys).orderBy(*[F.col(f).cast("string") for f in fields])
    first = found.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    a, b = long_form(truth, keys, fields).withColumnRenamed("value", "truth"), long_form(first, keys, fields).withColumnRenamed("value", "found")
    joined = a.join(b, [*keys, "field"], "left")
    t, f = comparable(F.col("truth")), comparable(F.col("found"))
    alike = [(t == x) & (f == y) | (t == y) & (f == x) for x, y in EQUIVALENT]
    same = (t == f) | (F.col("field").contains("region") & F.greatest(*alike))
    return joined.select(*keys, "field", F.lit(method).alias("method"), "truth", "found", same.alias("correct"))


def beyond(found: DataFrame, expected: DataFrame, group: list[str], order: list) -> DataFrame:
    """Found rows past the expected number (_n) of their group, in an order."""
    ranked = found.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.join(expected, group, "left").where(F.col("_rn") > F.coalesce("_n", F.lit(0))).drop("_rn", "_n")


def spurious(found: DataFrame, truth: DataFrame, group: list[str], field: str, method: str = "deterministic") -> DataFrame:
    """A miss for each row beyond the number expected in its group."""
    extra = beyond(found, truth.groupBy(*group).agg(F.count("*").alias("_n")), group, found.columns)
    return extra.select(F.lit(field).alias("field"), F.lit(method).alias("method"), F.lit(False).alias("correct"))


def accuracy(compared_rows: DataFrame, by: tuple[str, ...] = ("field", "method")) -> DataFrame:
    """correct, total and their ratio (NULL on an empty group), in order of `by`."""
    out = compared_rows.groupBy(*by).agg(F.count_if("correct").alias("correct"), F.count("*").alias("total"))
    return out.withColumn("accuracy", F.try_divide("correct", "total")).orderBy(*by)


def misses(compared_rows: DataFrame) -> DataFrame:
    """(field, key, truth, found) of what is wrong, in order."""
    keys = [c for c in compared_rows.columns if c not in ("field", "method", "truth", "found", "correct")]
    key = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return compared_rows.where(~F.col("correct")).select("field", key.alias("key"), "truth", "found").orderBy("field", "key", "truth")


def report(compared_rows: DataFrame, most_misses: int = 200) -> str:
    """Markdown: overall by method, each field, and the first misses."""
    lines = ["# Accuracy", ""]
    for r in accuracy(compared_rows, ("method",)).collect():
        lines.append(f"- {r['method']}: {r['correct']}/{r['total']} ({r['accuracy']:.1%})")
    lines += ["", "| field | method | correct | total | accuracy |", "| --- | --- | --- | --- | --- |"]
    for r in accuracy(compared_rows).collect():
        lines.append(f"| {r['field']} | {r['method']} | {r['correct']} | {r['total']} | {r['accuracy']:.1%} |")
    wrong = misses(compared_rows).limit(most_misses).collect()
    lines += ["", *[f"- {r['field']} {r['key']}: expected {r['truth']}, got {r['found']}" for r in wrong]]
    return "\n".join(lines).rstrip() + "\n"


class Entity(NamedTuple):
    """How rows of one table are compared: matched within `group` on `key`, field by field."""

    table: str
    group: tuple[str, ...]
    key: tuple[str, ...]
    fields: tuple[str, ...]
    method: str = "deterministic"


#: What is scored. Visits are matched by patient and day, children within their visit.
DAY = ("mrn", "encounter_date")
ENTITIES = [
    Entity("patients", (), ("mrn",), ("pms_id", "family_name", "given_name", "preferred_name", "date_of_birth", "sex", "phone_home")),
    Entity("encounters", ("mrn",), ("encounter_date",), ("encounter_date", "provider_name", "provider_role", "location_name", "follow_up_interval_days", "signed_by", "signed_at")),
    Entity("encounters", ("mrn",), ("encounter_date",), ("body_region", "laterality", "visit_type"), "model"),
    Entity("diagnoses", DAY, ("icd10_code",), ("icd10_code", "diagnosis_text", "is_primary")),
    Entity("prescriptions", DAY, ("drug_name",), ("drug_name", "strength", "strength_unit", "dose_form", "route", "sig_text", "quantity", "refills")),
    Entity("medication_snapshots", DAY, ("medication_name",), ("medication_name", "route")),
    Entity("vitals", DAY, (), ("bp_systolic", "bp_diastolic", "pulse", "respirations", "o2_sat", "temperature_f", "height_in", "weight_lbs", "bmi", "bsa")),
    Entity("procedures", DAY, (), ("procedure_name", "performed_date")),
    Entity("imaging_studies", DAY, ("modality",), ("modality", "performed_date", "laterality")),
    Entity("patient_history", ("mrn",), ("history_type", "item_text"), ("item_text",)),
]
#: How a field is brought to one spelling before it is compared.
SPELLINGS = {"sex": sex, "laterality": laterality}


def both_ways(truth: DataFrame, found: DataFrame, e: Entity, told_only: bool = False) -> DataFrame:
    """Truth rows against the found row of their key, and found rows beyond the number expected in their group as misses. With told_only, fields that the truth leaves open do not count."""
    spelled = lambda df: df.withColumns({f: SPELLINGS[f](F.col(f)) for f in e.fields if f in SPELLINGS})
    keys = [*e.group, *e.key]
    matched = {f"_{k}": comparable(F.col(k)) for k in keys}
    t, f = (spelled(df).withColumns(matched) for df in (truth, found))
    rows = compared(t, f, list(matched), list(e.fields), e.method).withColumn("field", F.concat(F.lit(f"{e.table}."), F.col("field")))
    if told_only:
        rows = rows.where("truth IS NOT NULL")
    rows = rows.select(F.concat_ws(" ", *matched).alias("key"), "field", "method", "truth", "found", "correct")
    if not e.group:
        return rows
    group = [f"_{k}" for k in e.group]
    told = F.col(e.fields[0]).cast("string")
    extra = beyond(f, t.groupBy(*group).agg(F.count("*").alias("_n")), group, [F.col(e.fields[0]).cast("string")])
    return rows.unionByName(extra.select(F.concat_ws(" ", *group).alias("key"), F.lit(f"{e.table}.{e.fields[0]}").alias("field"), F.lit(e.method).alias("method"), F.lit(None).cast("string").alias("truth"), told.alias("found"), F.lit(False).alias("correct")))


def evaluated(truth: dict[str, DataFrame], found: dict[str, DataFrame], entities: list[Entity] | None = None, models: bool = True) -> DataFrame:
    """All entities of a corpus or of one document. Tables carry mrn and, for children, encounter_date; `dated` adds them to a warehouse's."""
    parts = [both_ways(truth[e.table], found[e.table], e, told_only=e.table == "encounters") for e in entities or ENTITIES if e.table in truth and e.table in found and (models or e.method != "model")]
    return reduce(DataFrame.unionByName, parts)


def dated(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A warehouse's tables with the keys that truth is matched by."""
    people = tables["patients"].select("patient_id", "mrn")
    visits = tables["encounters"].join(people, "patient_id")
    when = visits.select("encounter_id", "mrn", "encounter_date")
    out = {"patients": tables["patients"], "encounters": visits}
    for name, rows in tables.items():
        if name not in out and {"encounter_id", "patient_id"} <= set(rows.columns):
            out[name] = rows.join(when, "encounter_id")
    out["patient_history"] = tables["patient_history"].join(people, "patient_id")
    return out
