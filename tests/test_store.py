import datetime
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from chartloom.functions import keys
from chartloom.operators import store
from chartloom.plans import views
from chartloom.schemas import MERGE_KEYS, SCHEMAS
from chartloom.sources import scratch
from chartloom.streaming import ingest

DAY = datetime.date(2025, 7, 2)


def frame(spark, table, *rows):
    return spark.createDataFrame([{f: r.get(f) for f in SCHEMAS[table].fieldNames()} for r in rows], SCHEMAS[table])


def bundle(spark, doc="d1", codes=("M17.11",), phone="1", visits=(("e1", DAY),)):
    return {
        "documents": frame(spark, "documents", {"document_id": doc, "file_name": f"{doc}.pdf"}),
        "patients": frame(spark, "patients", {"patient_id": "p1", "mrn": "p1", "legal_name": "DOE, Jane", "phone_home": phone}),
        "encounters": frame(spark, "encounters", *[{"encounter_id": e, "patient_id": "p1", "encounter_date": d, "source_document_id": doc} for e, d in visits]),
        "diagnoses": frame(spark, "diagnoses", *[{"diagnosis_id": f"{e}{c}", "encounter_id": e, "patient_id": "p1", "icd10_code": c, "is_primary": i == 0, "source_document_id": doc} for e, _ in visits for i, c in enumerate(codes)]),
        "prescriptions": frame(spark, "prescriptions", {"prescription_id": "r1", "encounter_id": "e1", "patient_id": "p1", "drug_name": "Meloxicam", "source_document_id": doc}),
    }


def test_key_parts_do_not_smear_and_null_is_empty(spark):
    k = lambda *p: spark.range(1).select(keys.hash_key(*[F.lit(x).cast("string") for x in p])).first()[0]
    assert k("ab", "c") != k("a", "bc")
    assert k("a", None) == k("a", "")
    n = spark.range(1).select(keys.normalised(F.lit(" A   b\n")), keys.normalised(F.lit(None))).first()
    assert tuple(n) == ("a b", "")


def test_last_wins_and_null_overwrites(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 1)], "k int, v string, n int")
    assert {tuple(r) for r in store.last_wins(rows, ["k"], F.col("n")).select("k", "v").collect()} == {(1, None), (2, "b")}
    out = store.upsert(rows.where("n = 1"), rows.where("n = 2"), ["k"])
    assert {tuple(r) for r in out.select("k", "v").collect()} == {(1, None), (2, "b")}


def test_writes_converge_sweep_and_restore(spark, tmp_path):
    w = store.Warehouse(spark, f"file://{tmp_path}/w")
    w.publish({"ref_drug_class": frame(spark, "ref_drug_class", {"drug_name": "MELOXICAM", "drug_class": "nsaid", "is_anti_inflammatory": True})})
    first = w.write(bundle(spark))
    assert w.verify(w.write(bundle(spark))) == []
    assert w.read("prescriptions").first()["drug_class"] == "nsaid"
    w.write(bundle(spark, codes=("M51.16",), phone=None))
    assert [r[0] for r in w.read("diagnoses").select("icd10_code").collect()] == ["M51.16"]
    assert w.read("patients").first()["phone_home"] is None
    w.write(bundle(spark, visits=(("e1", DAY), ("e0", datetime.date(2025, 1, 1)))))
    assert {tuple(r) for r in w.read("encounters").select("encounter_id", "encounter_seq").collect()} == {("e0", 1), ("e1", 2)}
    assert w.read("patients").first()["first_seen_date"] == datetime.date(2025, 1, 1)
    w.restore(first)
    assert w.read("encounters").count() == 1
    assert w.record_run({"status": "succeeded", "started_at": datetime.datetime(2025, 1, 1)})


def test_last_document_of_a_batch_owns_the_encounter(spark):
    a, b = bundle(spark, "d1", ("M17.11",)), bundle(spark, "d2", ("M16.11", "M25.51"))
    both = {n: a[n].unionByName(b[n]) for n in a}
    arrival = spark.createDataFrame([("d1", 1), ("d2", 2)], "document_id string, arrived int")
    out = ingest.last_document_wins(both, arrival)
    assert {r[0] for r in out["diagnoses"].select("icd10_code").collect()} == {"M16.11", "M25.51"}


def test_views(spark):
    t = {n: spark.createDataFrame([], SCHEMAS[n]) for n in SCHEMAS} | bundle(spark, codes=("M17.11", "M25.51"))
    t["ref_drug_class"] = frame(spark, "ref_drug_class", {"drug_name": "meloxicam", "drug_class": "nsaid", "is_anti_inflammatory": True})
    t["imaging_studies"] = frame(spark, "imaging_studies", {"imaging_id": "i", "encounter_id": "e1", "performed_date": DAY})
    row = views.encounter_summary(t).first()
    assert (row["primary_icd10_code"], row["diagnosis_count"], row["anti_inflammatory_active"], row["anti_inflammatory_on_arrival"], row["imaging_same_day"]) == ("M17.11", 2, True, False, True)
    line = views.patient_timeline(t).first()
    assert [d["icd10_code"] for d in line["diagnoses"]] == ["M17.11", "M25.51"]
    assert line["procedures"] == [] and line["vitals"] is None


def test_only_changed_tables_are_written(spark, tmp_path):
    w = store.Warehouse(spark, f"file://{tmp_path}/w")
    first = w.write(bundle(spark))
    second = w.publish({"ref_drug_class": frame(spark, "ref_drug_class", {"drug_name": "a", "drug_class": "b", "is_anti_inflammatory": False})})
    a, b = w.folders(first), w.folders(second)
    assert {n for n in b if a.get(n) != b[n]} == {"ref_drug_class"}
    assert w.verify(first) == ["ref_drug_class"] and w.read("ref_drug_class", first).count() == 0
    third = w.write(bundle(spark, codes=("M51.16",)))
    got = {r["name"]: tuple(r)[1:] for r in w.effects(second, third).collect()}
    assert got["diagnoses"] == (1, 0, 1) and got["patients"] == (0, 0, 0) and got["ref_drug_class"] == (0, 0, 0)
    assert w.vacuum(1) >= 1 and w.versions() == [third] and w.read("encounters").count() == 1


def test_fingerprints_ignore_order_and_see_values(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "b"), (2, None, "b")], "k int, x string, y string")
    prints = lambda df: tuple(store.fingerprint(df).first())
    assert prints(rows) == prints(rows.orderBy(F.desc("k")).repartition(3))
    assert len({prints(rows), prints(rows.distinct()), prints(rows.select("k", F.col("y").alias("x"), F.col("x").alias("y"))), prints(rows.limit(0))}) == 4


def test_runs_are_read_through_the_warehouse(spark, tmp_path):
    w = store.Warehouse(spark, f"file://{tmp_path}/w")
    assert w.read("ingest_runs").count() == 0
    assert w.record_run({"status": "succeeded", "started_at": datetime.datetime(2025, 1, 1)}) and w.record_run({"status": "failed"})
    assert sorted(r["status"] for r in w.read("ingest_runs").collect()) == ["failed", "succeeded"] and w.versions() == []


def test_scratch_tables_lie_in_the_shared_folder_and_go_together(spark):
    s = scratch.Scratch(spark)
    assert s.folder.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    kept = s.keep(spark.range(3), "n")
    assert kept.count() == 3 and kept.inputFiles()[0].startswith(s.folder.replace("file:///", "file:/").replace("file:/", "file:///"))
    s.release()
    assert not os.path.exists(s.folder.removeprefix("file://"))
    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda _: None), getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(SimpleNamespace(sparkContext=context))


def test_every_table_has_a_key():
    assert set(MERGE_KEYS) == set(SCHEMAS)
    assert all(set(k) <= set(SCHEMAS[t].fieldNames()) for t, k in MERGE_KEYS.items())
