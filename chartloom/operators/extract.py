"""Positioned blocks to the rows of every table, for any number of documents in one plan.

files(document_id, gcs_uri, file_name, file_bytes, error), pages(doc_id, page, width, height)
and blocks as in `geometry`. Every gap is a row of ingestion_issues: a file that could not be
read (its error is given) becomes a failed document with one issue, a row that breaks a rule
costs that row, an encounter that does takes its children with it, and no document touches
another.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import keys as K
from chartloom.functions.words import blank_as_null, plain_words, spaced
from chartloom.operators import classify, facts, geometry, segment, validate
from chartloom.schemas import SCHEMAS
from chartloom.sources.scratch import Scratch

FILES = "document_id string, gcs_uri string, file_name string, file_bytes long, error string"
PAGES = "doc_id string, page int, width double, height double"
VERSION = "1"
VISIT = ["doc_id", "visit"]
#: Sections that every visit should have.
EXPECTED = ["chief_complaint", "assessment", "plan", "imaging"]
DRAFT = ["doc_id", "day", "severity", "issue_type", "field_name", "detail"]


class Extraction(NamedTuple):
    """Rows of each table, and the intermediate tables that they read until they are written."""

    tables: dict[str, DataFrame]
    scratch: Scratch

    def release(self) -> None:
        self.scratch.release()


def draft(rows: DataFrame, severity: str, kind: str, field: str | Column, detail: str | Column, day: Column | None = None) -> DataFrame:
    """rows(doc_id, ...) as issues to be."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select("doc_id", (F.lit(None).cast("date") if day is None else day).alias("day"), F.lit(severity).alias("severity"), F.lit(kind).alias("issue_type"), lit(field).alias("field_name"), lit(detail).alias("detail"))


def numbered(blocks: DataFrame, by: list[str]) -> DataFrame:
    """blocks with n, their place in reading order."""
    return blocks.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*geometry.reading_key())))


def sections_text(blocks: DataFrame, names: list[str], alias: str = "text") -> DataFrame:
    """The text of one or several sections of each visit, in reading order, and its first page."""
    own = blocks.where(F.col("section").isin(names))
    return geometry.joined_text(VISIT, own).withColumnRenamed("text", alias).join(own.groupBy(*VISIT).agg(F.min("page").cast("long").alias("page")), VISIT)


def identified(files: DataFrame, placed: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, patient_id, mrn, ... of each readable file), and what was missing or contradictory: the header wins over the file name."""
    first = placed.groupBy("doc_id").agg(F.min("page").alias("page"))
    header = placed.where("region = 'header'").join(first, ["doc_id", "page"])
    mrn, pms = facts.file_ids(F.col("file_name"))
    both = files.where("error IS NULL").select(F.col("document_id").alias("doc_id"), mrn.alias("file_mrn"), pms.alias("file_pms")).join(facts.identity(header, ["doc_id"]), "doc_id", "left")
    both = both.withColumns({"header_mrn": F.col("mrn"), "header_pms": F.col("pms_id"), "born": F.col("date_of_birth")})
    both = both.withColumns({"mrn": F.coalesce("mrn", "file_mrn"), "pms_id": F.coalesce("pms_id", "file_pms"), "date_of_birth": F.try_to_date("born", "M/d/yyyy")})
    out = both.withColumn("patient_id", F.when(F.col("mrn").isNotNull(), K.patient_key(F.col("mrn"))))
    differs = lambda a, b: F.col(a) != F.col(b)
    told = lambda what, a, b: F.concat(F.lit(f"header {what} "), F.col(a), F.lit(" differs from that of the file name, "), F.col(b))
    drafts = [
        draft(out.where(differs("header_mrn", "file_mrn")), "warn", "identifier_mismatch", "mrn", told("MRN", "header_mrn", "file_mrn")),
        draft(out.where("header_mrn IS NULL AND mrn IS NOT NULL"), "warn", "unparsed_field", "mrn", "no MRN in the header; the file name's stands in"),
        draft(out.where("mrn IS NULL"), "error", "unparsed_field", "mrn", "no MRN in the header or the file name"),
        draft(out.where(differs("header_pms", "file_pms")), "warn", "identifier_mismatch", "pms_id", told("PMS ID", "header_pms", "file_pms")),
        draft(out.where("date_of_birth IS NULL"), "warn", "unparsed_field", "date_of_birth", F.coalesce(F.concat(F.lit("unreadable date of birth "), F.col("born")), F.lit("no date of birth in the header"))),
    ]
    return out.drop("file_mrn", "file_pms", "header_mrn", "header_pms", "born"), drafts


def dated_visits(placed: DataFrame, pages: DataFrame, people: DataFrame) -> DataFrame:
    """pages(doc_id, page) with the visit each belongs to, and its date or NULL."""
    text = geometry.joined_text(["doc_id", "page"], placed.where("region != 'sidebar'"))
    known = pages.select("doc_id", "page").join(text, ["doc_id", "page"], "left").join(people.select("doc_id", "date_of_birth"), "doc_id").join(geometry.page_labels(placed), ["doc_id", "page"], "left")
    return segment.split_visits(known.withColumn("page_date", segment.service_date(F.coalesce("text", F.lit("")), F.col("date_of_birth"))))


def located(content: DataFrame, pages: DataFrame, rail: DataFrame) -> DataFrame:
    """(doc_id, visit, location): of the rail, else the first line that all feet of a visit's pages repeat and that is no number, name or heading."""
    told = sections_text(rail, ["location"], "_rail").select(*VISIT, facts.clean_prose(F.col("_rail")).alias("_rail"))
    foot = geometry.repeated_footers(content.where("region != 'header'"), pages, VISIT)
    plain = ~F.col("text").rlike("[0-9]") & facts.provider_in(F.col("text")).isNull() & ~F.col("text").endswith(":") & segment.heading_key(F.col("text")).isNull()
    line = foot.where(plain).groupBy(*VISIT).agg(F.min_by("text", "place").alias("_foot"))
    return told.join(line, VISIT, "full").select(*VISIT, F.coalesce("_rail", "_foot").alias("location"))


def visits_of(paged: DataFrame, content: DataFrame, pages: DataFrame, body: DataFrame, rail: DataFrame, people: DataFrame) -> DataFrame:
    """One row a dated visit with all that its encounter says of itself."""
    spans = paged.groupBy(*VISIT, "visit_date").agg(F.min("page").cast("long").alias("source_page_start"), F.max("page").cast("long").alias("source_page_end"))
    header = content.where("region = 'header'").join(spans.select(*VISIT, F.col("source_page_start").alias("_first")), VISIT).where("page = _first")
    texts = geometry.joined_text([*VISIT, "section"], body).groupBy(*VISIT).agg(*[F.max(F.when(F.col("section") == s, F.col("text"))).alias(f"_{s}") for s in ("chief_complaint", "hpi", "note", "plan", "assessment")])
    out = spans.join(people.select("doc_id", "patient_id"), "doc_id")
    for part, name in ((geometry.joined_text(VISIT, content.where("region = 'body'")), "_body"), (geometry.joined_text(VISIT, header), "_header")):
        out = out.join(part.withColumnRenamed("text", name), VISIT, "left").withColumn(name, F.coalesce(name, F.lit("")))
    out = out.join(texts, VISIT, "left").join(located(content, pages, rail), VISIT, "left")
    order = Window.partitionBy("doc_id").orderBy("visit_date", "visit")
    some = lambda c: blank_as_null(F.trim(c))
    out = out.withColumns({"_by": facts.provider(F.col("_header"), F.col("_body")), "_again": facts.follow_up(F.coalesce(some("_plan"), some("_assessment"), F.col("_body"))), "_signed": facts.signature(F.col("_body"))})
    return out.select(
        *VISIT, "patient_id", F.col("visit_date").alias("encounter_date"), F.row_number().over(order).cast("long").alias("encounter_seq"), F.col("_by.name").alias("provider_name"), F.col("_by.role").alias("provider_role"), F.col("_by.is_primary").alias("is_primary_provider"),
        F.first("location", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("location_name"), facts.clean_prose(F.col("_chief_complaint")).alias("chief_complaint_raw"), facts.clean_prose(F.col("_hpi")).alias("hpi_text"),
        facts.clean_prose(F.coalesce(some("_note"), F.col("_plan"))).alias("note_text"), F.col("_again.days").alias("follow_up_interval_days"), F.col("_again.phrase").alias("follow_up_raw"), F.col("_signed.who").alias("signed_by"), F.col("_signed.at").alias("signed_at"),
        F.col("doc_id").alias("source_document_id"), "source_page_start", "source_page_end", F.coalesce("_plan", F.lit("")).alias("_plan"),
        F.concat_ws("\n", some("_chief_complaint"), some("_hpi"), some(F.concat_ws(" ", "_plan", "_note"))).alias("_prose"),
    ).withColumn("encounter_id", K.encounter_key(F.col("patient_id"), F.col("encounter_date"), F.col("provider_name")))


def prescribes(plan: Column) -> Column:
    """Does a plan speak of prescribing?"""
    said = spaced(plan)
    return F.exists(plain_words(plan), lambda w: w.isin("prescription", "refill") | w.startswith("prescrib")) | said.contains(" modify regimen ") | said.contains(" medication management ")


def children(visits: DataFrame, body: DataFrame, rail: DataFrame) -> dict[str, DataFrame]:
    """Rows of every child table, keyed, with doc_id, visit and day beside their columns."""
    dated = visits.select(*VISIT, "encounter_id", "patient_id", F.col("encounter_date").alias("day"))
    own = lambda *names: body.where(F.col("section").isin(*names))
    lines = lambda df: numbered(df, VISIT).select(*VISIT, "n", "text", F.col("page").cast("long").alias("page"))
    joined = lambda df: df.join(dated, VISIT)
    day = dated.select(*VISIT, F.col("day").alias("visit_date"))
    c = F.col
    written = facts.prescriptions(sections_text(body, ["prescriptions", "plan"]), VISIT)
    listed = facts.medications(numbered(rail.where("section = 'current_medications'"), VISIT).select(*VISIT, "n", "text", F.col("page").cast("long").alias("page")), VISIT)
    past = numbered(rail.join(dated, VISIT), ["doc_id"]).select("doc_id", "patient_id", "day", "n", "section", "text", F.col("page").cast("long").alias("page"))
    exam = facts.exam(geometry.text_columns(own("exam"), [*VISIT, "page"]), VISIT)
    out = {
        "vitals": joined(facts.vitals(own("vitals"), VISIT)).withColumn("taken_date", F.coalesce("taken_date", "day")),
        "diagnoses": joined(facts.diagnoses(lines(own("assessment")), VISIT)).withColumn("diagnosis_id", K.diagnosis_key(c("encounter_id"), c("icd10_code"), c("diagnosis_text"))),
        "prescriptions": joined(written).withColumn("prescription_id", K.prescription_key(c("encounter_id"), c("drug_name"), c("strength"), c("sig_text"))),
        "medication_snapshots": joined(listed),
        "procedures": joined(facts.procedures(sections_text(body, ["operative_note"]).join(day, VISIT), VISIT)).withColumn("procedure_id", K.procedure_key(c("encounter_id"), c("procedure_name"), c("performed_date"))),
        "imaging_studies": joined(facts.imaging(lines(own("imaging")).join(day, VISIT), VISIT)).withColumn("imaging_id", K.imaging_key(c("encounter_id"), c("modality"), c("body_part"), c("performed_date"))),
        "exam_findings": joined(exam.withColumnRenamed("source_page", "page")).withColumn("finding_id", K.finding_key(c("encounter_id"), c("body_part"), c("laterality"), c("finding_type"), c("measure_name"), c("ordinal"))),
        "patient_history": facts.history(past, ["doc_id"]).join(dated.groupBy("doc_id", "patient_id").agg(F.min("day").alias("day")), "doc_id").withColumn("history_id", K.history_key(c("patient_id"), c("history_type"), c("item_text"))),
    }
    return {name: rows.withColumns({"source_document_id": c("doc_id"), "source_page": c("page").cast("long")}) for name, rows in out.items()}


#: What an issue calls a row of each table.
LABELS = {"vitals": "vitals", "diagnoses": "diagnosis", "prescriptions": "prescription", "medication_snapshots": "medication", "procedures": "procedure", "imaging_studies": "imaging", "exam_findings": "exam_finding", "patient_history": "patient_history", "encounters": "encounter", "patients": "patient"}


def conformed(rows: DataFrame, table: str) -> DataFrame:
    """The table's columns with their types; those that the rows lack are NULL."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def extract(files: DataFrame, pages: DataFrame, blocks: DataFrame, model: Callable[[str], str] | None = None, model_name: str | None = None, run_id: str | None = None, version: str = VERSION) -> Extraction:
    """Rows of every table a document has rows in, each document's identity, visits, sections and facts parsed together with those of all others."""
    scratch = Scratch(files.sparkSession)
    files, pages = scratch.keep(files, "files"), scratch.keep(pages, "pages")
    placed = scratch.keep(geometry.with_regions(blocks.where(F.trim("text") != ""), pages), "placed")
    known_by, drafts = identified(files, placed)
    people = scratch.keep(known_by, "people")
    drafts = [scratch.keep(validate.union_all(drafts), "gaps")]
    paged = scratch.keep(dated_visits(placed, pages, people), "paged")
    content = placed.join(paged.where("visit_date IS NOT NULL"), ["doc_id", "page"])
    body = scratch.keep(segment.with_sections(content.where("region = 'body'"), VISIT), "body")
    rail = scratch.keep(segment.with_sections(content.where("region = 'sidebar'"), VISIT), "rail")
    seen = visits_of(paged.where("visit_date IS NOT NULL"), content, pages, body, rail, people)
    visits = scratch.keep(classify.classified(seen, "_prose", model).withColumn("llm_model", F.when(F.col("llm_confidence").isNotNull(), F.lit(model_name))), "visits")

    day = F.col("encounter_date")
    rows = {name: scratch.keep(df, f"rows-{name}") for name, df in children(visits, body, rail).items()}
    dated = visits.select(*VISIT, F.col("encounter_date").alias("day"))
    lacking = validate.missing(dated, EXPECTED, body.select(*VISIT, "section"), VISIT).join(dated, VISIT)
    untold = visits.where(prescribes(F.col("_plan"))).join(rows["prescriptions"].select(*VISIT).distinct(), VISIT, "left_anti")
    drafts += [
        draft(people.join(paged.where("visit_date IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_anti"), "error", "unparsed_field", "encounter_date", "no page has a date of service"),
        draft(visits.where("provider_name IS NULL"), "warn", "unparsed_field", "provider_name", "no provider is named", day),
        draft(lacking, "warn", "missing_section", F.col("section"), F.concat(F.lit("no section "), F.col("section")), F.col("day")),
        draft(dated.join(body.where("section = 'vitals'").select(*VISIT).distinct(), VISIT, "left_anti"), "warn", "missing_section", "vitals", "no vitals recorded", F.col("day")),
        draft(untold, "warn", "unparsed_field", "prescriptions", "the plan speaks of prescribing but names no drug, sig, quantity and refills", day),
        draft(visits.where("classify_error IS NOT NULL"), "error", "classification_failed", "prose", F.col("classify_error"), day),
        draft(files.where("error IS NOT NULL").withColumnRenamed("document_id", "doc_id"), "error", "unreadable_document", "document", F.col("error")),
    ]

    kept, broken = validate.checked(visits, "encounters")
    lost = broken.select("encounter_id").distinct()
    drafts.append(draft(broken, "error", "validation_failed", "encounter", F.concat_ws(", ", "broken"), day))
    tables = {"encounters": kept}
    for name, df in rows.items():
        good, bad = validate.checked(df if name == "patient_history" else df.join(lost, "encounter_id", "left_anti"), name)
        tables[name] = good
        drafts.append(draft(bad, "error", "validation_failed", LABELS[name], F.concat_ws(", ", "broken"), F.col("day")))
    ends = tables["encounters"].groupBy("doc_id").agg(F.min("encounter_date").alias("first_seen_date"), F.max("encounter_date").alias("last_seen_date"))
    known = people.where("patient_id IS NOT NULL").join(ends, "doc_id", "left").withColumn("source_document_id", F.col("doc_id")).withColumn("ingested_at", F.current_timestamp())
    tables["patients"], bad = validate.checked(known, "patients")
    drafts.append(draft(bad, "error", "validation_failed", "patient", F.concat_ws(", ", "broken")))

    by_day = visits.groupBy("doc_id", F.col("encounter_date").alias("day")).agg(F.max_by("encounter_id", "encounter_seq").alias("encounter_id"))
    found = validate.union_all(drafts).join(people.select("doc_id", "patient_id"), "doc_id", "left").join(by_day, ["doc_id", "day"], "left")
    issue = K.issue_key(F.coalesce("patient_id", "doc_id"), F.col("day"), F.col("issue_type"), F.col("field_name"))
    issues = found.select(issue.alias("issue_id"), F.col("doc_id").alias("document_id"), "encounter_id", "severity", "issue_type", "field_name", "detail", F.current_timestamp().alias("created_at"), F.lit(run_id).alias("ingest_run_id")).dropDuplicates(["issue_id", "document_id", "detail"])
    tables["ingestion_issues"] = issues = scratch.keep(issues, "issues")
    mrn, pms = facts.file_ids(F.col("file_name"))
    counted = files.join(pages.groupBy(F.col("doc_id").alias("document_id")).agg(F.count_distinct("page").alias("page_count")), "document_id", "left")
    given = counted.withColumns({"page_count": F.coalesce("page_count", F.lit(0)), "mrn_from_filename": mrn, "pms_id_from_filename": pms, "ingested_at": F.current_timestamp(), "ingest_run_id": F.lit(run_id), "pipeline_version": F.lit(version)})
    tables["documents"] = validate.parse_status(given, tables["encounters"], issues)
    return Extraction({name: conformed(df, name) for name, df in tables.items()}, scratch)
