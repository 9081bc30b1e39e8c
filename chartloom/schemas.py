"""The warehouse's tables: columns, merge keys, and which tables a document write sweeps."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

#: Table layouts, as DDL.
DDL: dict[str, str] = {
    "documents": "document_id string, gcs_uri string, file_name string, file_bytes bigint, page_count bigint, mrn_from_filename string, pms_id_from_filename string, ingested_at timestamp, ingest_run_id string, pipeline_version string, parse_status string",
    "patients": "patient_id string, mrn string, pms_id string, legal_name string, family_name string, given_name string, preferred_name string, date_of_birth date, sex string, phone_home string, phone_work string, first_seen_date date, last_seen_date date, source_document_id string, ingested_at timestamp",
    "encounters": "encounter_id string, patient_id string, encounter_date date, encounter_seq bigint, provider_name string, provider_role string, is_primary_provider boolean, location_name string, chief_complaint_raw string, body_region string, laterality string, visit_type string, hpi_text string, hpi_summary string, note_text string, follow_up_interval_days bigint, follow_up_raw string, signed_by string, signed_at timestamp, source_document_id string, source_page_start bigint, source_page_end bigint, llm_model string, llm_confidence double",
    "diagnoses": "diagnosis_id string, encounter_id string, patient_id string, icd10_code string, icd10_description string, diagnosis_text string, is_primary boolean, body_region string, laterality string, source string, source_document_id string, source_page bigint",
    "prescriptions": "prescription_id string, encounter_id string, patient_id string, drug_name string, strength string, strength_unit string, dose_form string, route string, sig_text string, quantity double, quantity_unit string, refills bigint, duration_days bigint, is_prn boolean, drug_class string, action string, source_document_id string, source_page bigint",
    "medication_snapshots": "encounter_id string, patient_id string, medication_name string, strength string, strength_unit string, dose_form string, route string, source_document_id string, source_page bigint",
    "imaging_studies": "imaging_id string, encounter_id string, patient_id string, modality string, body_part string, laterality string, performed_date date, interpretation_text string, impression string, source_document_id string, source_page bigint",
    "procedures": "procedure_id string, encounter_id string, patient_id string, procedure_name string, body_part string, laterality string, performed_date date, surgeon_name string, note_text string, source_document_id string, source_page bigint",
    "vitals": "encounter_id string, patient_id string, taken_by string, taken_date date, bp_systolic bigint, bp_diastolic bigint, pulse bigint, respirations bigint, o2_sat bigint, temperature_f double, height_in double, weight_lbs double, bmi double, bsa double, is_patient_reported boolean, source_document_id string, source_page bigint",
    "exam_findings": "finding_id string, encounter_id string, patient_id string, body_part string, laterality string, finding_type string, measure_name string, value_numeric double, value_text string, unit string, source_document_id string, source_page bigint",
    "ingestion_issues": "issue_id string, document_id string, encounter_id string, severity string, issue_type string, field_name string, detail string, created_at timestamp, ingest_run_id string",
    "patient_history": "history_id string, patient_id string, history_type string, item_text string, source_document_id string, source_page bigint",
    "ingest_runs": "run_id string, document_id string, gcs_uri string, trigger_source string, status string, started_at timestamp, finished_at timestamp, encounters_written bigint, issues_warn bigint, issues_error bigint, pipeline_version string, error_detail string",
    "ref_drug_class": "drug_name string, drug_class string, is_anti_inflammatory boolean",
}
TYPES = {"string": StringType, "bigint": LongType, "double": DoubleType, "boolean": BooleanType, "date": DateType, "timestamp": TimestampType}
SCHEMAS = {name: StructType([StructField(c, TYPES[t]()) for c, t in (x.strip().split(" ") for x in ddl.split(","))]) for name, ddl in DDL.items()}

#: The key of each table.
MERGE_KEYS: dict[str, tuple[str, ...]] = {
    "documents": ("document_id",), "patients": ("patient_id",), "encounters": ("encounter_id",), "vitals": ("encounter_id",),
    "diagnoses": ("diagnosis_id",), "prescriptions": ("prescription_id",), "medication_snapshots": ("encounter_id", "medication_name"),
    "patient_history": ("history_id",), "procedures": ("procedure_id",), "imaging_studies": ("imaging_id",), "exam_findings": ("finding_id",),
    "ingestion_issues": ("issue_id",), "ingest_runs": ("run_id",), "ref_drug_class": ("drug_name",),
}
#: Children of an encounter: a document write replaces all of an encounter's rows.
SWEPT = ("vitals", "diagnoses", "prescriptions", "medication_snapshots", "procedures", "imaging_studies", "exam_findings")

#: Drugs, their class, and whether they reduce inflammation.
DRUGS = [
    ("meloxicam", "NSAID", True), ("ibuprofen", "NSAID", True), ("naproxen", "NSAID", True), ("diclofenac", "NSAID", True), ("celecoxib", "NSAID (COX-2)", True), ("indomethacin", "NSAID", True),
    ("methylprednisolone", "corticosteroid", True), ("prednisone", "corticosteroid", True), ("triamcinolone", "corticosteroid", True), ("dexamethasone", "corticosteroid", True),
    ("acetaminophen", "analgesic", False), ("tramadol", "opioid analgesic", False), ("hydrocodone-acetaminophen", "opioid analgesic", False), ("cyclobenzaprine", "muscle relaxant", False),
    ("methocarbamol", "muscle relaxant", False), ("tizanidine", "muscle relaxant", False), ("gabapentin", "anticonvulsant / neuropathic", False), ("duloxetine", "SNRI", False), ("nebivolol", "beta blocker", False),
    ("olmesartan-amlodipin-hcthiazid", "antihypertensive combination", False), ("lisinopril", "ACE inhibitor", False), ("metformin", "biguanide", False), ("atorvastatin", "statin", False),
    ("levothyroxine", "thyroid hormone", False), ("omeprazole", "proton pump inhibitor", False), ("vitamin d3", "supplement", False), ("calcium carbonate", "supplement", False), ("alendronate", "bisphosphonate", False),
]
