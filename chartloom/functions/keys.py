"""Deterministic keys: hashes over normalised parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u001f"


def normalised(value: Column) -> Column:
    """White space collapsed, lower case, NULL as the empty string."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"(?U)\s+", " ")))


def hash_key(*parts: Column | str) -> Column:
    """SHA-256 over parts with a separator no field can hold; NULL parts count as empty."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.array_join(F.array(*columns), SEPARATOR, ""), 256)


def iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def patient_key(mrn: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(mrn, F.lit("")), r"(?U)\s+", " "))


def encounter_key(patient: Column, day: Column, provider: Column) -> Column:
    return hash_key("encounter", patient, iso(day), normalised(provider))


def document_key(content: Column) -> Column:
    return F.sha2(content, 256)


def diagnosis_key(encounter: Column, code: Column, text: Column) -> Column:
    return hash_key("diagnosis", encounter, normalised(code), normalised(text))


def prescription_key(encounter: Column, drug: Column, strength: Column, sig: Column) -> Column:
    return hash_key("prescription", encounter, normalised(drug), normalised(strength), normalised(sig))


def imaging_key(encounter: Column, modality: Column, part: Column, day: Column) -> Column:
    return hash_key("imaging", encounter, normalised(modality), normalised(part), iso(day))


def procedure_key(encounter: Column, name: Column, day: Column) -> Column:
    return hash_key("procedure", encounter, normalised(name), iso(day))


def finding_key(encounter: Column, part: Column, side: Column, kind: Column, measure: Column, ordinal: Column) -> Column:
    """By what is measured; findings without a measure by their ordinal."""
    return hash_key("exam", encounter, normalised(part), normalised(side), kind, normalised(measure), F.when(F.coalesce(measure, F.lit("")) == "", ordinal.cast("string")).otherwise(F.lit("")))


def history_key(patient: Column, kind: Column, item: Column) -> Column:
    return hash_key("history", patient, kind, normalised(item))


def issue_key(scope: Column, day: Column, kind: Column, field: Column) -> Column:
    return hash_key("issue", scope, iso(day), kind, normalised(field))
