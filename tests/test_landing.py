"""Blocks to every table in one call, and documents that land one after the other."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from chartloom.operators import extract, score, serve, store
from chartloom.plans import views
from chartloom.schemas import MERGE_KEYS, SCHEMAS
from chartloom.sources import files as sources
from chartloom.streaming import ingest

DAY = datetime.date(2025, 7, 23)


def line(text, x, y, width=250):
    return (text, float(x), float(y), float(x + width), float(y + 10))


def page(number, visit_page, date="07/23/2025", mrn="1234567", extra=(), provider="Dorian Vance, MD (Primary Provider)"):
    """A page with a two-row head, a rail on the left and a body, as (number, width, height, blocks)."""
    head = [line("DOE, Jane M. (Janie)", 30, 20), line(f"MRN: {mrn}", 330, 20, 80), line("DOB: 09/15/1991", 430, 20, 90), line(f"Date of Service: {date}", 30, 34), line("Sex: Female", 330, 34, 60), line(f"Phone: (312) 555-0101  Page {visit_page}", 430, 34, 120)]
    rail = ["Current Medications", "nebivolol — Oral", "meloxicam 15 mg Oral - tablet", "Medical History", "Hypertension", "Surgical History", "None", "Allergies", "Latex"]
    body = [f"Seen by {provider}", "Chief Complaint: right knee pain", "HPI", "Pain for two weeks , worse on stairs.", "Vitals", "Ht 67.0 in  Wt 180.2 lbs BP: 128/82", "Physical Exam", "Right Knee Active ROM:", "Flexion: 120 degrees", "Imaging", f"XR knee (right) — performed {date}", "Impression: mild narrowing", "Assessment", "Osteoarthritis of right knee (M17.11) [Primary]", "Knee effusion", "Plan", "ibuprofen 600 mg tablet PO", "Sig: Take 1 po tid x 10 days", "Quantity: 30 Tablet Refills: 1 Action: new", "Follow up in 3 weeks", "Electronically signed by: Dorian Vance, MD on 07/23/2025 4:05 PM", *extra]
    foot = [line("Lakeview Orthopedics", 260, 760, 120)]
    return (number, 612.0, 792.0, head + [line(t, 30, 90 + 14 * i, 100) for i, t in enumerate(rail)] + [line(t, 260, 90 + 14 * i, 300) for i, t in enumerate(body)] + foot)


def chart(*pages):
    return json.dumps(pages).encode()


def json_reader():
    """Stands in for a reader of real documents: pages as JSON. A local function, so that workers get it by value."""
    def reader(content):
        if content.startswith(b"broken"):
            raise ValueError("no such format")
        return [(n, w, h, [tuple(b) for b in blocks]) for n, w, h, blocks in json.loads(content)]

    return reader


reader = json_reader()
GOOD = chart(page(1, 1))
TWO = chart(page(1, 1, mrn="7654321"), page(2, 1, "08/20/2025", "7654321", provider="Marla Whitcomb, NP"))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Good documents beside bad ones, in one batch."""
    d = tmp_path_factory.mktemp("inbox")
    for name, content in {"a_MRN1234567_PMS42.pdf": GOOD, "b.PDF": TWO, "broken.pdf": b"broken", "nodate.pdf": chart((1, 612.0, 792.0, [line("no date here", 30, 20), line("nor here", 30, 300)])), "x.txt": b"no document"}.items():
        (d / name).write_bytes(content)
    w = store.Warehouse(spark, f"file://{tmp_path_factory.mktemp('warehouse')}/w")
    w.publish({"ref_drug_class": sources.seed_drugs(spark)})
    ingest.ingest_available(spark, f"file://{d}", w, reader, f"file://{tmp_path_factory.mktemp('checkpoint')}")
    return d, w


def rows(w, table, *columns):
    return sorted((tuple(r) for r in w.read(table).select(*columns).collect()), key=str)


def test_a_bad_document_costs_the_others_nothing(landed):
    _, w = landed
    assert rows(w, "documents", "file_name", "parse_status", "page_count") == [("a_MRN1234567_PMS42.pdf", "ok", 1), ("b.PDF", "ok", 2), ("broken.pdf", "failed", 0), ("nodate.pdf", "failed", 1)]
    errors = {(r["field_name"], r["issue_type"], r["severity"]) for r in w.read("ingestion_issues").where("severity = 'error'").collect()}
    assert errors == {("document", "unreadable_document", "error"), ("mrn", "unparsed_field", "error"), ("encounter_date", "unparsed_field", "error")}
    assert rows(w, "ingest_runs", "status", "encounters_written", "issues_error") == [("failed", 0, 1), ("failed", 0, 2), ("succeeded", 1, 0), ("succeeded", 2, 0)]


def test_facts_of_a_visit(landed):
    _, w = landed
    assert rows(w, "patients", "mrn", "pms_id", "legal_name", "preferred_name", "date_of_birth", "sex", "phone_home", "first_seen_date", "last_seen_date") == [
        ("1234567", "42", "DOE, Jane M. (Janie)", "Janie", datetime.date(1991, 9, 15), "F", "(312) 555-0101", DAY, DAY),
        ("7654321", None, "DOE, Jane M. (Janie)", "Janie", datetime.date(1991, 9, 15), "F", "(312) 555-0101", DAY, datetime.date(2025, 8, 20)),
    ]
    e = w.read("encounters").where("patient_id = '1234567'").first()
    assert (e["provider_name"], e["provider_role"], e["is_primary_provider"], e["location_name"], e["chief_complaint_raw"], e["hpi_text"]) == ("Dorian Vance", "MD", True, "Lakeview Orthopedics", "right knee pain", "Pain for two weeks, worse on stairs")
    assert (e["follow_up_interval_days"], e["follow_up_raw"], e["signed_by"], e["signed_at"], e["encounter_seq"], e["source_page_start"], e["llm_confidence"]) == (21, "Follow up in 3 weeks", "Dorian Vance, MD", datetime.datetime(2025, 7, 23, 16, 5), 1, 1, None)
    of = lambda t, *c: [x[1:] for x in rows(w, t, "patient_id", *c) if x[0] == "1234567"]
    assert of("diagnoses", "icd10_code", "diagnosis_text", "is_primary", "body_region", "laterality") == [("M17.11", "Osteoarthritis of right knee", True, "knee", "right"), (None, "Knee effusion", False, None, None)]
    assert of("prescriptions", "drug_name", "strength", "quantity", "refills", "duration_days", "drug_class", "action") == [("ibuprofen", "600", 30.0, 1, 10, "NSAID", "new")]
    assert of("medication_snapshots", "medication_name", "route") == [("meloxicam", "Oral"), ("nebivolol", "Oral")]
    assert of("vitals", "bp_systolic", "height_in", "weight_lbs", "pulse", "taken_date") == [(128, 67.0, 180.2, None, DAY)]
    assert of("imaging_studies", "modality", "body_part", "laterality", "performed_date", "impression") == [("XR", "knee", "right", DAY, "mild narrowing")]
    assert of("exam_findings", "body_part", "laterality", "finding_type", "measure_name", "value_numeric", "unit") == [("knee", "right", "rom_active", "Flexion", 120.0, "degrees")]
    assert of("patient_history", "history_type", "item_text") == [("allergy", "Latex"), ("medical", "Hypertension")]


def test_every_row_has_its_parents_and_its_document(landed):
    _, w = landed
    visits = {r[0] for r in rows(w, "encounters", "encounter_id")}
    known = {r[0] for r in rows(w, "documents", "document_id")}
    assert len(visits) == 3
    for table in SCHEMAS:
        df = w.read(table)
        assert df.columns == SCHEMAS[table].fieldNames()
        if table != "ref_drug_class":
            assert df.select(*MERGE_KEYS[table]).distinct().count() == df.count()
        if "encounter_id" in df.columns and table != "ingestion_issues":
            assert {r[0] for r in df.select("encounter_id").collect()} <= visits
        if "source_document_id" in df.columns:
            assert {r[0] for r in df.select("source_document_id").collect()} <= known


def test_writes_converge_whatever_the_name(spark, landed):
    d, w = landed
    files = spark.read.format("binaryFile").load(f"file://{d}")
    renamed = files.withColumn("path", F.concat(F.lit("file:/other/"), F.element_at(F.split("path", "/"), -1)))
    assert ingest.drift(w, renamed, reader) == []
    assert rows(w, "documents", "gcs_uri")[0][0].startswith("file:/other/")


def test_clear_and_restore(spark, landed):
    _, w = landed
    before = w.versions()[-1]
    doc = w.read("documents").where("file_name = 'b.PDF'").first()["document_id"]
    assert set(w.rearm(doc).values()) == {0}
    assert w.read("encounters").count() == 1 and "encounters" in w.verify(before)
    w.restore(before)
    assert w.verify(before) == [] and w.read("encounters").count() == 3


def test_views_over_what_landed(spark, landed):
    _, w = landed
    t = {n: w.read(n) for n in SCHEMAS}
    summary, timeline = views.encounter_summary(t), views.patient_timeline(t)
    row = summary.where("mrn = '1234567'").first()
    assert summary.columns == views.SUMMARY and timeline.columns == views.TIMELINE
    assert (row["primary_icd10_code"], row["body_region_effective"], row["diagnosis_count"], row["prescription_count"], row["medications_on_arrival_count"], row["procedure_count"]) == ("M17.11", "knee", 2, 1, 2, 0)
    assert (row["anti_inflammatory_on_arrival"], row["anti_inflammatory_prescribed"], row["imaging_same_day"]) == (True, True, True)
    session = serve.serving_session(spark, {"v_encounter_summary": summary, "v_patient_timeline": timeline})
    answers = {name: serve.run_sql(session, q) for name, q in serve.CANNED.items()}
    assert {a["status"] for a in answers.values()} == {"ok"}
    assert answers["conditions"]["rows"] == [{"primary_icd10_code": "M17.11", "wording": "Osteoarthritis of right knee", "patients": 2, "visits": 3}]
    assert answers["patients_with_history"]["rows"] == [{"patients": 2}]
    assert [r["mrn"] for r in serve.find_patient(timeline, "jan").collect()] == ["1234567", "7654321"]
    found = serve.find_patient(timeline, "7654321").collect()
    assert [(r["encounter_count"], r["first_seen_date"]) for r in found] == [(2, DAY)]
    assert [r["encounter_date"] for r in serve.patient_timeline(timeline, "7654321").collect()] == [DAY, datetime.date(2025, 8, 20)]


def test_scoring_counts_both_directions(spark, landed):
    _, w = landed
    found = score.dated({n: w.read(n) for n in SCHEMAS})
    perfect = score.evaluated(found, found, models=False)
    assert perfect.where("NOT correct").count() == 0
    wrong = found["diagnoses"].withColumn("diagnosis_text", F.upper("diagnosis_text")).where("icd10_code IS NOT NULL")
    out = score.evaluated({"diagnoses": wrong}, found)
    got = {r["field"]: (r["correct"], r["total"]) for r in score.accuracy(out).collect()}
    assert got == {"diagnoses.diagnosis_text": (3, 3), "diagnoses.icd10_code": (3, 6), "diagnoses.is_primary": (3, 3)}
    assert "expected None, got" in score.report(out)


def test_every_gap_is_an_issue_and_costs_no_more_than_itself(spark):
    def changed(p, drop=(), **texts):
        return [(texts.get(next((k for k in texts if b[0].startswith(k)), ""), b[0]), *b[1:]) for b in p[3] if not b[0].startswith(tuple(drop) or "\0")]

    documents = {
        "mismatch": ("MRN999_PMS1.pdf", page(1, 1)[3]),
        "fallback": ("MRN888_PMS2.pdf", changed(page(1, 1, mrn="none"), DOB="DOB: 13/45/1991")),
        "row": ("r.pdf", [(b[0].replace("BP: 128/82", "BP: 999/82"), *b[1:]) for b in page(1, 1)[3]]),
        "visit": ("v.pdf", changed(page(1, 1), drop=["MRN"])),
        "dose": ("d.pdf", changed(page(1, 1, mrn="5550001", extra=["Plan", "Modify Regimen: Modify prescription therapy."]), drop=["ibuprofen", "Sig", "Quantity"])),
    }
    files = spark.createDataFrame([(d, "u", name, 1, None) for d, (name, _) in documents.items()], extract.FILES)
    pages = spark.createDataFrame([(d, 1, 612.0, 792.0) for d in documents], extract.PAGES)
    blocks = spark.createDataFrame([(d, i, 1, *b) for d, (_, page_blocks) in documents.items() for i, b in enumerate(page_blocks)], sources.BLOCKS)
    out = extract.extract(files, pages, blocks)
    t = {n: df.collect() for n, df in out.tables.items()}
    out.release()
    assert {(r["document_id"], r["severity"], r["issue_type"], r["field_name"]) for r in t["ingestion_issues"]} == {
        ("mismatch", "warn", "identifier_mismatch", "mrn"), ("fallback", "warn", "unparsed_field", "mrn"), ("fallback", "warn", "unparsed_field", "date_of_birth"), ("row", "error", "validation_failed", "vitals"),
        ("visit", "error", "unparsed_field", "mrn"), ("visit", "error", "validation_failed", "encounter"), ("visit", "error", "validation_failed", "patient_history"), ("dose", "warn", "unparsed_field", "prescriptions"),
    }
    assert {(r["source_document_id"], r["mrn"]) for r in t["patients"]} == {("mismatch", "1234567"), ("fallback", "888"), ("row", "1234567"), ("dose", "5550001")}
    assert {r["document_id"]: r["parse_status"] for r in t["documents"]} == {"mismatch": "ok", "fallback": "ok", "row": "partial", "visit": "failed", "dose": "ok"}
    of = lambda table: {r["source_document_id"] for r in t[table]}
    assert of("vitals") == {"mismatch", "fallback", "dose"} and of("diagnoses") == {"mismatch", "fallback", "row", "dose"} and of("prescriptions") == {"mismatch", "fallback", "row"}


def test_a_failing_store_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(GOOD)
    w = store.Warehouse(spark, f"file://{tmp_path}/w")

    def full(_):
        raise OSError("disk full")

    w.publish, publish = full, w.publish
    go = lambda: ingest.ingest_available(spark, f"file://{tmp_path}/in", w, reader, f"file://{tmp_path}/c")
    with pytest.raises(Exception, match="disk full"):
        go()
    assert [r["status"] for r in w.read("ingest_runs").collect()] == ["failed"]
    w.publish = publish
    go()
    assert w.read("encounters").count() == 1
