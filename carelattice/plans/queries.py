"""The registered queries over the fixture views: each applies operators and names its columns as the SQL form does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.operators import csvbatch, dq, fhir, gold, governance, hl7, identity, terminology
from carelattice.sources.files import split_messages

from . import faults, fixtures as fx, written

Query = Callable[[SparkSession, str], DataFrame]


def _time(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _day(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _summary(s: SparkSession, d: str) -> DataFrame:
    return gold.patient_summary(fx.patients(s, d), fx.encounters(s, d), fx.diagnoses(s, d), fx.AS_OF)


def patient_risk_summary(s: SparkSession, d: str) -> DataFrame:
    out = _summary(s, d).drop("umpi", "elixhauser_index", "as_of_date", "risk_score_updated_ts", "refreshed_ts")
    return out.withColumns({c: _day(c) for c in ("last_encounter_date", "birth_date")})


def charlson_index(s: SparkSession, d: str) -> DataFrame:
    return gold.charlson_index(fx.diagnoses(s, d))


def chronic_flags(s: SparkSession, d: str) -> DataFrame:
    return gold.chronic_flags(fx.diagnoses(s, d))


def utilization_12m(s: SparkSession, d: str) -> DataFrame:
    return gold.utilization(fx.encounters(s, d), fx.AS_OF).drop("last_encounter_date")


def last_encounter(s: SparkSession, d: str) -> DataFrame:
    return gold.utilization(fx.encounters(s, d), fx.AS_OF).select("umpi", _day("last_encounter_date").alias("last_encounter_date"))


def pcp_attribution(s: SparkSession, d: str) -> DataFrame:
    return gold.pcp_attribution(fx.encounters(s, d), fx.AS_OF)


def readmission_30d(s: SparkSession, d: str) -> DataFrame:
    feed = gold.adt_feed(gold.adt_events(fx.encounters(s, d)), fx.diagnoses(s, d, place=True), ties=fx.PLACE)
    return feed.select("patient_hash", "encounter_id", "event_type", "event_label", "event_category", _time("event_datetime").alias("event_datetime"), "is_readmission_30d", _time("prior_discharge_datetime").alias("prior_discharge_datetime"), F.round("days_since_prior_discharge", 6).alias("days_since_prior_discharge"), "primary_dx")


def event_readmission(s: SparkSession, d: str) -> DataFrame:
    events = fx.event_stream(s, d).filter(F.col("event_type").isin("A01", "A03"))
    return gold.readmissions(events).select(F.col("arrival_seq").alias("event_id"), "is_readmission_30d", _time("exact_prior_discharge").alias("prior_discharge"))


def hba1c_control(s: SparkSession, d: str) -> DataFrame:
    coded = terminology.normalize_observations(fx.observations(s, d))
    out = gold.hba1c_control(fx.patients(s, d), fx.diagnoses(s, d), coded, fx.YEAR)
    return out.select("patient_hash", "tenant_id", "in_numerator", "evidence_value", _day("evidence_date").alias("evidence_date"))


def uscdi_gaps(s: SparkSession, d: str) -> DataFrame:
    k = F.col("arrival_seq")
    people = fx.patients(s, d).withColumns({"given_name": F.when(k % 7 != 0, F.col("given_name")).otherwise(""), "birth_date": F.when(k % 11 != 0, F.col("birth_date"))})
    return gold.uscdi_export(people).select("umpi", F.array_join("missing_elements", ",").alias("missing_elements"), "qhin_ready")


def state_metrics(s: SparkSession, d: str) -> DataFrame:
    return gold.state_metrics(governance.operator_only(_summary(s, d), True)).withColumn("as_of_date", _day("as_of_date"))


def uscdi_view(s: SparkSession, d: str) -> DataFrame:
    return governance.uscdi_view(_summary(s, d)).withColumn("last_encounter_date", _day("last_encounter_date"))


def tenant_view(s: SparkSession, d: str) -> DataFrame:
    return governance.tenant_view(_summary(s, d), "TENANT_1").select("patient_hash", "charlson_index")


def _coded(s: SparkSession, d: str) -> DataFrame:
    return terminology.normalize_observations(fx.observations(s, d))


def loinc_map(s: SparkSession, d: str) -> DataFrame:
    return _coded(s, d).select("source_record_id", "loinc_code", "normalization_method")


def rxnorm_map(s: SparkSession, d: str) -> DataFrame:
    return fx.drugs(s, d).select(F.col("arrival_seq").alias("p_partkey"), terminology.rxnorm(F.col("drug")).alias("rxnorm_code"))


def snomed_map(s: SparkSession, d: str) -> DataFrame:
    return fx.diagnoses(s, d).groupBy("icd10_code").agg(F.count("*").alias("n")).withColumn("snomed_code", terminology.snomed(F.col("icd10_code")))


def unmapped_codes(s: SparkSession, d: str) -> DataFrame:
    return terminology.unmapped(_coded(s, d)).groupBy("source_display", "source_code").agg(F.count("*").alias("occurrences"))


def normalization_log(s: SparkSession, d: str) -> DataFrame:
    return terminology.normalization_log(_coded(s, d), "ingest_fhir_bundles", "clinical_observations", "1").select("source_id", "source_table", "target_table", "mapping_type", "source_value", "source_system", "mapped_value", "mapped_system", "mapping_method", F.col("mapping_confidence").alias("confidence"), "pipeline_version")


def hl7_split(s: SparkSession, d: str) -> DataFrame:
    rows = fx.hl7_raw(s, d).select(F.floor(F.col("arrival_seq") / 100).alias("batch"), F.struct("arrival_seq", "raw_message").alias("x"))
    files = rows.groupBy("batch").agg(F.concat_ws("\n\n", F.transform(F.sort_array(F.collect_list("x")), lambda x: x["raw_message"])).alias("value"))  # 100 messages a group
    return split_messages(files).groupBy("batch").agg(F.count("*").alias("messages"))


def _parsed(s: SparkSession, d: str) -> DataFrame:
    return hl7.parse_messages(fx.hl7_raw(s, d))


def hl7_msh(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).select("message_control_id", "sending_application", "sending_facility", "hl7_version", _time("message_datetime").alias("message_datetime"))


def hl7_ztn(s: SparkSession, d: str) -> DataFrame:
    rows, key = hl7.with_ztn(fx.hl7_raw(s, d).withColumn("m", hl7.msh_fields(F.col("raw_message"))), F.col("raw_message"), F.lit("|")), hl7.ztn_value
    return rows.select(F.col("m.control_id").alias("message_control_id"), key("TENANT_ID").alias("tenant"), key("SOURCE_SYSTEM").alias("source"), key("BATCH_ID").alias("batch"))


def hl7_tenant(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).groupBy("tenant_id").agg(F.count("*").alias("messages"))


def hl7_bronze(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).select("message_control_id", "tenant_id", "source_system", "message_type", "message_event", "feed_type", "validation_status")


def _adt(s: SparkSession, d: str) -> DataFrame:
    return hl7.parse_adt(_parsed(s, d))


def hl7_dq(s: SparkSession, d: str) -> DataFrame:
    return dq.hl7_findings(_adt(s, d)).select("source_record_id", "error_code", "field_path")


def dq_counts(s: SparkSession, d: str) -> DataFrame:
    return dq.counts(dq.hl7_findings(_adt(s, d)))


def bronze_counts(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).groupBy("sending_facility", "validation_status", "message_type", "message_event").agg(F.count("*").alias("messages"), F.count("tenant_id").alias("with_tenant"))


def hl7_encounters(s: SparkSession, d: str) -> DataFrame:
    rows = hl7.adt_encounters(hl7.admissions(_adt(s, d)))
    return rows.select("message_control_id", "mrn", "encounter_class", "encounter_status", _time("period_start").alias("period_start"), _time("period_end").alias("period_end"), "facility", "attending_provider_npi")


def hl7_conditions(s: SparkSession, d: str) -> DataFrame:
    return hl7.adt_conditions(hl7.admissions(_adt(s, d))).select("message_control_id", "icd10_code", "clinical_status", _time("onset_datetime").alias("onset"))


def oru_observations(s: SparkSession, d: str) -> DataFrame:
    return hl7.oru_observations(_parsed(s, d)).select("message_control_id", "source_code", "value_quantity", "value_unit", "reference_range_low", "reference_range_high", "interpretation_code", "observation_status")


def _bundles(s: SparkSession, d: str, *kinds: str) -> DataFrame:
    """Parsed bundles with what all resources have, and the fields of these kinds."""
    return fhir.parse_bundles(fx.fhir_raw(s, d), kinds=kinds)


def _resources(s: SparkSession, d: str) -> DataFrame:
    return fhir.resources(_bundles(s, d))


def _of(s: SparkSession, d: str, kind: str) -> DataFrame:
    """A parse for resources of one kind and their subjects."""
    return fhir.resources(_bundles(s, d, kind), keep_bundle=False)


def fhir_bundles(s: SparkSession, d: str) -> DataFrame:
    return _bundles(s, d).select("bundle_id", "tenant_id", "source_system", F.array_join("resource_types", ",").alias("resource_types"))


def fhir_resources(s: SparkSession, d: str) -> DataFrame:
    return _resources(s, d).groupBy("resource_type", "supported").agg(F.count("*").alias("n"), F.count("bundle_payload").alias("with_payload"))


def fhir_patients(s: SparkSession, d: str) -> DataFrame:
    return fhir.patient_identities(_of(s, d, "Patient")).select("source_id", "source_mrn", "family_name", "given_name", _day("birth_date").alias("birth_date"), "postal_code").distinct()


def fhir_observations(s: SparkSession, d: str) -> DataFrame:
    rows = fhir.of_subjects(terminology.normalize_observations(fhir.observations(_of(s, d, "Observation"))))
    return rows.select("source_record_id", F.col("subject_key").alias("umpi"), "loinc_code", "normalization_method", "value_quantity", "value_unit", _time("effective_datetime").alias("effective"))


def fhir_encounters(s: SparkSession, d: str) -> DataFrame:
    rows = fhir.of_subjects(fhir.encounters(_of(s, d, "Encounter")))
    return rows.select("source_record_id", F.col("subject_key").alias("umpi"), "encounter_class", _time("period_start").alias("period_start"), F.round("length_of_stay_hours", 6).alias("length_of_stay_hours"), "facility_name")


def fhir_conditions(s: SparkSession, d: str) -> DataFrame:
    rows = fhir.of_subjects(fhir.conditions(_of(s, d, "Condition")))
    return rows.select("source_record_id", F.col("subject_key").alias("umpi"), "icd10_code", "clinical_status", "condition_category")


def fhir_dq(s: SparkSession, d: str) -> DataFrame:
    parsed = _bundles(s, d, "Patient")
    return dq.fhir_findings(parsed).select("error_code", "source_record_id")


def fhir_counts(s: SparkSession, d: str) -> DataFrame:
    return dq.bundle_counts(_bundles(s, d))


def csv_patients(s: SparkSession, d: str) -> DataFrame:
    return csvbatch.patients(fx.csv_raw(s, d)).select("source_mrn", "given_name", "family_name", _day("birth_date").alias("birth_date"), "address_line", "city", "postal_code")


def csv_conditions(s: SparkSession, d: str) -> DataFrame:
    return csvbatch.conditions(csvbatch.patients(fx.csv_raw(s, d))).groupBy("source_record_id", "icd10_code", "clinical_status").agg(F.count("*").alias("n"))


def _labs(s: SparkSession, d: str) -> DataFrame:
    people = csvbatch.patients(fx.csv_raw(s, d)).withColumn("umpi", F.concat(F.lit("U"), F.substring("source_mrn", 3, 20)))
    return csvbatch.link_patients(terminology.code_labs(csvbatch.labs(fx.lab_rows(s, d))), people)


def csv_labs(s: SparkSession, d: str) -> DataFrame:
    return _labs(s, d).select("source_record_id", "umpi", "loinc_code", "value_quantity", "value_string", _day("effective_datetime").alias("effective"))


def csv_dq_bronze(s: SparkSession, d: str) -> DataFrame:
    return dq.csv_bronze_findings(fx.csv_raw(s, d), "patients").select("source_record_id", "error_code", "field_path")


def csv_dq_silver(s: SparkSession, d: str) -> DataFrame:
    return dq.counts(dq.csv_silver_findings(fx.csv_raw(s, d)))


def csv_lab_dq(s: SparkSession, d: str) -> DataFrame:
    return dq.counts(dq.csv_lab_findings(terminology.code_labs(csvbatch.labs(fx.lab_rows(s, d)))), "error_code")


def csv_duplicates(s: SparkSession, d: str) -> DataFrame:
    return dq.with_first_row(fx.csv_raw(s, d), "patient_id").filter("row_idx > first_row_idx").select("patient_id", "row_idx", "first_row_idx")


def csv_audit(s: SparkSession, d: str) -> DataFrame:
    rows = fx.csv_raw(s, d)
    return csvbatch.csv_batches(rows, ["file_name"], dq.csv_bronze_findings(rows, "patients"))


def csv_payload(s: SparkSession, d: str) -> DataFrame:
    rows = csvbatch.payload_rows(fx.csv_payload(s, d), csvbatch.PATIENT_COLUMNS)
    return csvbatch.patients(rows).groupBy("source_mrn", "address_line").agg(F.count("*").alias("n"))


def audit_log(s: SparkSession, d: str) -> DataFrame:
    rows = _adt(s, d).select("facility", (F.size(dq.found(dq.hl7_rules())) > 0).alias("bad"))
    return dq.audit_log(rows, ["facility"], F.col("bad"))


def _resolved(s: SparkSession, d: str) -> DataFrame:
    return identity.resolve(fx.identities(s, d))


def mpi_resolve(s: SparkSession, d: str) -> DataFrame:
    return _resolved(s, d).select("source_id", "umpi", "match_method", "match_confidence", "is_new_record")


def mpi_crosswalk(s: SparkSession, d: str) -> DataFrame:
    return identity.crosswalk(_resolved(s, d)).groupBy("umpi").agg(F.count("*").alias("records"), F.countDistinct("source_system").alias("systems"))


def mpi_index(s: SparkSession, d: str) -> DataFrame:
    return identity.patient_index(_resolved(s, d)).select("umpi", "tenant_id", "family_name", "given_name", "linked_record_count")


def dq_scorecard(s: SparkSession, d: str) -> DataFrame:
    return gold.tenant_scorecard(fx.patients(s, d), _coded(s, d), fx.diagnoses(s, d), _resolved(s, d))


def patient_observation_preview(s: SparkSession, d: str) -> DataFrame:
    seen = fx.observations(s, d).select("umpi", "source_display", "value_quantity", _time("effective_datetime").alias("effective"))
    return fx.patients(s, d).select("umpi", "family_name").join(seen, "umpi", "left").orderBy("umpi", "effective")


def union_conditions(s: SparkSession, d: str) -> DataFrame:
    ours = fx.diagnoses(s, d).select(F.lit("FHIR").alias("source"), "icd10_code")
    theirs = hl7.adt_conditions(hl7.admissions(_adt(s, d))).select(F.lit("HL7").alias("source"), "icd10_code")
    return ours.unionByName(theirs).groupBy("source", "icd10_code").agg(F.count("*").alias("n"))


_ALL = (
    patient_risk_summary, charlson_index, chronic_flags, utilization_12m, last_encounter, pcp_attribution, readmission_30d, event_readmission, hba1c_control, uscdi_gaps, state_metrics, uscdi_view, tenant_view,
    loinc_map, rxnorm_map, snomed_map, unmapped_codes, normalization_log, hl7_split, hl7_msh, hl7_ztn, hl7_tenant, hl7_bronze, hl7_dq, dq_counts, bronze_counts, hl7_encounters, hl7_conditions, oru_observations,
    fhir_bundles, fhir_resources, fhir_patients, fhir_observations, fhir_encounters, fhir_conditions, fhir_dq, fhir_counts, csv_patients, csv_conditions, csv_labs, csv_dq_bronze, csv_dq_silver, csv_lab_dq, csv_duplicates, csv_audit, csv_payload,
    audit_log, mpi_resolve, mpi_crosswalk, mpi_index, dq_scorecard, patient_observation_preview, union_conditions,
)


def queries() -> dict[str, Query]:
    return {**{f.__name__: f for f in _ALL}, **faults.queries(), **written.queries()}
