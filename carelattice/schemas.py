"""Table schemas as compact DDL, and their CREATE TABLE statements.

Fixed values: column names, types and order are the tables' interface.
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

_RUN = "pipeline_run_id string"

_DEFINITIONS = {
    "ingest_hl7_messages": f"message_id string, tenant_id string, source_system string, source_facility string, message_type string, message_event string, raw_message string, validation_status string, received_at timestamp, {_RUN}",
    "ingest_fhir_bundles": f"bundle_id string, tenant_id string, source_system string, bundle_type string, resource_types array<string>, raw_bundle string, validation_status string, received_at timestamp, {_RUN}",
    "ingest_csv_batches": f"batch_id string, tenant_id string, source_system string, file_name string, file_type string, file_size_bytes bigint, row_count bigint, raw_content string, validation_status string, received_at timestamp, {_RUN}",
    "pipeline_runs": f"run_seq bigint, event string, outcome string, recorded_at timestamp, {_RUN}",
    "audit_ingest_log": f"log_id string, tenant_id string, source_system string, source_name string, target_table string, record_count bigint, pass_count bigint, error_count bigint, started_at timestamp, completed_at timestamp, {_RUN}",
    "audit_validation_errors": f"error_id string, tenant_id string, source_table string, source_record_id string, error_code string, error_severity string, error_message string, field_path string, raw_value string, detected_at timestamp, resolved boolean, source_name string, {_RUN}",
    "mpi_patient_index": f"umpi string, tenant_ids array<string>, family_name string, given_name string, birth_date date, linked_record_count int, created_at timestamp, {_RUN}",
    "mpi_identity_crosswalk": f"crosswalk_id string, umpi string, tenant_id string, source_system string, source_record_id string, source_mrn string, source_facility_npi string, match_method string, match_confidence double, {_RUN}",
    "clinical_patients": f"patient_id string, umpi string, tenant_id string, source_system string, source_record_id string, family_name string, given_name string, birth_date date, gender string, address_line string, city string, state string, postal_code string, phone string, email string, insurance_id string, pcp_npi string, last_visit_date date, is_deceased boolean, created_at timestamp, {_RUN}",
    "clinical_encounters": f"encounter_id string, umpi string, tenant_id string, source_system string, source_record_id string, encounter_class string, encounter_status string, period_start timestamp, period_end timestamp, length_of_stay_hours double, facility_name string, facility_npi string, attending_provider_npi string, attending_provider_name string, created_at timestamp, {_RUN}",
    "clinical_observations": f"observation_id string, umpi string, tenant_id string, encounter_id string, source_system string, source_record_id string, loinc_code string, loinc_display string, source_code string, source_display string, value_quantity double, value_string string, value_unit string, reference_range_low double, reference_range_high double, interpretation_code string, effective_datetime timestamp, observation_status string, normalization_method string, created_at timestamp, {_RUN}",
    "clinical_conditions": f"condition_id string, umpi string, tenant_id string, encounter_id string, source_system string, source_record_id string, icd10_code string, icd10_display string, condition_category string, clinical_status string, verification_status string, onset_datetime timestamp, abatement_datetime timestamp, recorded_at timestamp, created_at timestamp, {_RUN}",
    "clinical_medications": f"medication_id string, umpi string, tenant_id string, encounter_id string, source_system string, source_record_id string, rxnorm_code string, rxnorm_display string, source_code string, source_display string, dose_quantity double, dose_unit string, route string, frequency string, status string, authored_on timestamp, start_date date, end_date date, created_at timestamp, {_RUN}",
    "clinical_procedures": f"procedure_id string, umpi string, tenant_id string, encounter_id string, source_system string, source_record_id string, procedure_code string, procedure_display string, code_system string, status string, performed_at timestamp, performer_npi string, created_at timestamp, {_RUN}",
    "clinical_immunizations": f"immunization_id string, umpi string, tenant_id string, encounter_id string, source_system string, source_record_id string, cvx_code string, cvx_display string, status string, occurrence_at timestamp, lot_number string, performer_npi string, created_at timestamp, {_RUN}",
    "terminology_unmapped_codes": f"unmapped_id string, tenant_id string, source_table string, source_record_id string, source_system string, source_code string, source_display string, target_vocabulary string, occurrence_count int, first_seen_at timestamp, last_seen_at timestamp, resolved boolean, resolved_code string, resolved_at timestamp, {_RUN}",
    "terminology_normalization_log": f"log_id string, tenant_id string, source_table string, source_id string, target_table string, target_id string, mapping_type string, source_value string, source_system string, mapped_value string, mapped_system string, mapping_confidence double, mapping_method string, pipeline_version string, processed_ts timestamp, {_RUN}",
    "dq_tenant_scorecard": f"scorecard_id string, tenant_id string, patient_count bigint, pct_complete_demographics double, pct_loinc_coverage double, pct_icd10_coverage double, pct_rxnorm_coverage double, mpi_match_rate double, unmapped_code_count bigint, generated_at timestamp, {_RUN}",
    "analytics_patient_summary": f"patient_hash string, tenant_id string, charlson_index int, risk_tier string, chronic_condition_flags map<string,boolean>, total_encounter_count int, ed_visit_count int, inpatient_days int, last_encounter_date date, generated_at timestamp, {_RUN}",
    "analytics_quality_measures": f"measure_id string, patient_hash string, tenant_id string, measure_code string, measure_steward string, measurement_period_start date, measurement_period_end date, in_denominator boolean, in_numerator boolean, evidence_value double, evidence_date date, generated_at timestamp, {_RUN}",
    "analytics_adt_events": f"event_id string, patient_hash string, tenant_id string, event_type string, event_label string, event_datetime timestamp, facility_name string, is_readmission_30d boolean, prior_discharge_datetime timestamp, days_since_prior_discharge double, generated_at timestamp, {_RUN}",
    "export_uscdi_v3_patient": f"export_id string, umpi string, tenant_id string, uscdi_payload string, missing_elements array<string>, qhin_ready boolean, uscdi_version string, exported_at timestamp, {_RUN}",
}

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()), "map<string,boolean>": T.MapType(T.StringType(), T.BooleanType()),
}


def _schema(columns: str) -> StructType:
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in columns.split(", "))])


TABLES: dict[str, StructType] = {name: _schema(columns) for name, columns in _DEFINITIONS.items()}

LAYERS = {
    "bronze": [n for n in TABLES if n.startswith(("ingest_", "audit_", "pipeline_"))],
    "silver": [n for n in TABLES if n.startswith(("mpi_", "clinical_", "terminology_", "dq_"))],
    "gold": [n for n in TABLES if n.startswith(("analytics_", "export_"))],
}


def ddl(table: str, schema: StructType, partition_by: str | None = None) -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet" + (f" PARTITIONED BY ({partition_by})" if partition_by else "")
