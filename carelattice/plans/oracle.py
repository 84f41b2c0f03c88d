"""The same queries as SQL over the star-schema tables, for an independent engine."""

from __future__ import annotations

from carelattice.functions.codes import ADT_COARSE, ADT_LABELS, CHARLSON, CHRONIC, LOINC, RXNORM, SNOMED

from . import faults, written
from .fixtures import AS_OF, CODES, DRUGS, NAMES, YEAR


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _case(column: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


def _prefix(column: str, prefixes: str) -> str:
    return "(" + " OR ".join(f"starts_with({column}, '{p}')" for p in prefixes.split()) + ")"


def _any(column: str, prefixes: str) -> str:
    return f"coalesce(bool_or({_prefix(column, prefixes)}), false)"


VIEWS = {
    "patients": """SELECT 'P' || lpad(c_custkey::VARCHAR, 9, '0') AS umpi, c_custkey AS arrival_seq, 'TENANT_' || (c_nationkey % 4) AS tenant_id,
      DATE '1930-01-01' + (c_custkey * 7919 % 27000)::INT AS birth_date, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, 'G' || (c_custkey % 53) AS given_name,
      'F' || (c_custkey % 97) AS family_name, (70000 + c_custkey % 500)::VARCHAR AS postal_code, CASE WHEN c_custkey % 5 <> 0 THEN lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS ssn_last4, c_custkey FROM customer""",
    "encounters": """SELECT o_orderkey AS k, o_custkey, 'E' || lpad(o_orderkey::VARCHAR, 10, '0') AS encounter_id, 'P' || lpad(o_custkey::VARCHAR, 9, '0') AS umpi, 'TENANT_' || (o_custkey % 4) AS tenant_id,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'EMER' WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'IMP' ELSE 'AMB' END AS encounter_class, o_orderdate + to_hours((o_orderkey % 24)::INT) AS period_start,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours((o_orderkey % 24 + o_orderkey % 15 * 24 + o_orderkey % 7)::INT) END AS period_end, 'FAC-' || (o_orderkey % 6) AS facility_name, 'NPI-' || (o_orderkey % 10) AS npi, 'Dr ' || (o_orderkey % 10) AS dr FROM orders""",
    "lines": """SELECT l.*, o.o_custkey, l_orderkey * 10 + l_linenumber AS seq, 'P' || lpad(o.o_custkey::VARCHAR, 9, '0') AS umpi, 'TENANT_' || (o.o_custkey % 4) AS tenant_id,
      'E' || lpad(l_orderkey::VARCHAR, 10, '0') AS encounter_id FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey""",
    "diagnoses": f"""SELECT seq, umpi, tenant_id, encounter_id, coalesce({_list(CODES)}[(l_partkey % 300)::INT + 1], 'Z00.00') AS icd, l_linenumber AS diagnosis_rank, CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'resolved' END AS clinical_status FROM lines""",
    "observations": f"""SELECT seq, 'O' || seq AS source_record_id, umpi, tenant_id, {_list(NAMES)}[(l_suppkey % 12)::INT + 1] AS source_display, round(4 + l_quantity / 5, 1) AS value_quantity, l_shipdate AS effective, CASE WHEN l_returnflag = 'R' THEN 'preliminary' ELSE 'final' END AS status FROM lines""",
    "coded": f"""SELECT *, {_case("lower(trim(source_display))", LOINC)} AS loinc_code FROM observations""",
    "flags": "SELECT umpi, " + ", ".join(f"{_any('icd', p)} AS {n}" for n, (_, p) in CHARLSON.items() if n != "diabetes_uncomplicated") + f", {_any('icd', CHARLSON['diabetes_uncomplicated'][1])} AND NOT {_any('icd', CHARLSON['diabetes_complicated'][1])} AS diabetes_uncomplicated, " + ", ".join(f"{_any('icd', p)} AS has_{n.lower()}" for n, p in CHRONIC.items()) + " FROM diagnoses GROUP BY umpi",
    "charlson": "SELECT umpi, " + " + ".join(f"{n}::INT * {w}" for n, (w, _) in CHARLSON.items()) + " AS charlson_index FROM flags",
    "util": f"""SELECT umpi, count(*) FILTER (recent) AS encounters_12m, count(*) FILTER (recent AND encounter_class = 'EMER') AS ed_visits_12m,
      coalesce(sum(floor((epoch_us(period_end) - epoch_us(period_start)) / 86400000000.0)) FILTER (recent AND encounter_class = 'IMP'), 0)::BIGINT AS inpatient_days_12m, max(period_start::DATE) AS last_date
      FROM (SELECT *, period_start >= TIMESTAMP '{AS_OF.year - 1}-08-01' AS recent FROM encounters) GROUP BY umpi""",
    "pcp": f"""SELECT umpi, npi AS pcp_npi, dr AS pcp_name FROM (SELECT umpi, npi, dr, row_number() OVER (PARTITION BY umpi ORDER BY count(*) DESC, min(k)) AS n FROM encounters WHERE period_start >= TIMESTAMP '{AS_OF.year - 1}-08-01' GROUP BY umpi, npi, dr) WHERE n = 1""",
    "summary": f"""SELECT p.umpi, sha256(p.umpi) AS patient_hash, p.tenant_id, p.given_name || ' ' || p.family_name AS full_name, date_diff('year', p.birth_date, DATE '{AS_OF}') - (strftime(p.birth_date, '%m%d') > '{AS_OF:%m%d}')::INT AS age, p.gender, p.postal_code,
      coalesce(c.charlson_index, 0) AS charlson_index, CASE WHEN coalesce(c.charlson_index, 0) = 0 THEN 'LOW' WHEN c.charlson_index <= 2 THEN 'MODERATE' WHEN c.charlson_index <= 4 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_tier,
      {", ".join(f"coalesce(f.has_{n.lower()}, false) AS has_{n.lower()}" for n in CHRONIC)}, coalesce(u.encounters_12m, 0) AS encounters_12m, coalesce(u.ed_visits_12m, 0) AS ed_visits_12m, coalesce(u.inpatient_days_12m, 0) AS inpatient_days_12m, strftime(u.last_date, '%Y-%m-%d') AS last_encounter_date, pcp_npi, pcp_name
      FROM patients p LEFT JOIN charlson c USING (umpi) LEFT JOIN flags f USING (umpi) LEFT JOIN util u USING (umpi) LEFT JOIN pcp USING (umpi)""",
    "adt": """SELECT umpi, tenant_id, encounter_id, facility_name, 'A01' AS event_type, period_start AS moment FROM encounters UNION ALL SELECT umpi, tenant_id, encounter_id, facility_name, 'A03', period_end FROM encounters WHERE period_end IS NOT NULL""",
    "msgs": f"""SELECT o_orderkey AS k, o_custkey AS c, c_nationkey, o_orderkey % 2 = 0 AS a01, o_orderdate + to_hours((o_orderkey % 24)::INT) AS moment, DATE '1930-01-01' + (o_custkey * 7919 % 27000)::INT AS born, {_list(CODES)}[(o_orderkey % 30)::INT + 1] AS dx FROM orders JOIN customer ON o_custkey = c_custkey""",
    "csvp": f"""SELECT c_custkey AS c, c_custkey + again * 1000000000 AS row_idx, again, DATE '1930-01-01' + (c_custkey * 7919 % 27000)::INT AS born, {_list(CODES)}[(c_custkey % 30)::INT + 1] AS dx FROM customer, (VALUES (0), (1)) v(again) WHERE again = 0 OR c_custkey % 30 = 7""",
    "labs": f"""SELECT *, {_list(NAMES)}[(l_suppkey % 12)::INT + 1] AS test_name, CASE WHEN seq % 31 = 0 THEN 'POSITIVE' WHEN seq % 37 = 0 THEN NULL ELSE round(4 + l_quantity / 5, 1)::VARCHAR END AS result_value FROM lines""",
}
_USES = {
    "diagnoses": ["lines"], "observations": ["lines"], "coded": ["observations"], "flags": ["diagnoses"], "charlson": ["flags"], "util": ["encounters"], "pcp": ["encounters"],
    "summary": ["patients", "charlson", "flags", "util", "pcp"], "adt": ["encounters"], "labs": ["lines"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for m in _USES.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n"


_HL7_TENANT = "CASE WHEN k % 7 <> 0 THEN 'TENANT_' || (c_nationkey % 4) WHEN c % 50 <> 4 THEN 'FAC' || (k % 6) ELSE 'UNKNOWN' END"
_FHIR_TENANT = "CASE WHEN k % 17 <> 0 THEN 'TENANT_' || (c_nationkey % 4) ELSE 'UNKNOWN' END"
_TS = "'%Y-%m-%d %H:%M:%S'"
_HL7_CODES = """SELECT k::VARCHAR AS k, 'HL7_MISSING_MSH4' AS error_code, 'MSH-4' AS field_path FROM msgs WHERE c % 50 = 4
  UNION ALL SELECT k::VARCHAR, 'HL7_MISSING_PID5', 'PID-5' FROM msgs WHERE c % 50 = 1
  UNION ALL SELECT k::VARCHAR, 'HL7_MALFORMED_DOB', 'PID-7' FROM msgs WHERE c % 50 = 2
  UNION ALL SELECT k::VARCHAR, 'HL7_INVALID_GENDER', 'PID-8' FROM msgs WHERE c % 50 = 3"""
_READMIT = f"""SELECT a.*, (SELECT max(d.moment) FROM adt d WHERE d.umpi = a.umpi AND d.event_type = 'A03' AND d.moment < a.moment) AS prior FROM adt a"""
_CSV_DQ = """SELECT row_idx, c, 'CSV_MISSING_REQUIRED_FIELD' AS error_code, 'last_name' AS field_path FROM csvp WHERE c % 25 = 4
  UNION ALL SELECT row_idx, c, 'CSV_MISSING_REQUIRED_FIELD', 'zip' FROM csvp WHERE c % 60 = 8
  UNION ALL SELECT row_idx, c, 'CSV_DUPLICATE_RECORD', 'patient_id' FROM csvp WHERE again = 1
  UNION ALL SELECT row_idx, c, 'CSV_MALFORMED_DOB', 'dob' FROM csvp WHERE c % 20 = 5"""
_MPI = """SELECT source_id, sha256('umpi~' || c_custkey) AS umpi, CASE WHEN b = 0 THEN 'NEW_RECORD' WHEN ssn_last4 IS NOT NULL THEN 'SSN4_DOB_NAME' ELSE 'DOB_NAME_ZIP' END AS match_method,
  (CASE WHEN b = 0 THEN 0.0 WHEN ssn_last4 IS NOT NULL THEN 1.0 ELSE 0.95 END)::DOUBLE AS match_confidence, b = 0 AS is_new_record, tenant_id, family_name, given_name
  FROM (SELECT *, (CASE WHEN b = 0 THEN 'A' ELSE 'B' END) || umpi AS source_id FROM patients, (VALUES (0), (1)) v(b))"""


def sql() -> dict[str, str]:
    chronic = ", ".join(f"has_{n.lower()}" for n in CHRONIC)
    return {
        "patient_risk_summary": _with("summary") + "SELECT s.* EXCLUDE (umpi), strftime(p.birth_date, '%Y-%m-%d') AS birth_date, 'OK' AS state, CASE WHEN pcp_npi IS NOT NULL THEN 'ENCOUNTER_FREQUENCY' END AS attribution_method FROM summary s JOIN patients p USING (umpi)",
        "charlson_index": _with("charlson") + "SELECT umpi, charlson_index FROM charlson",
        "chronic_flags": _with("flags") + f"SELECT umpi, {chronic} FROM flags",
        "utilization_12m": _with("util") + "SELECT umpi, encounters_12m, ed_visits_12m, inpatient_days_12m FROM util",
        "last_encounter": _with("util") + "SELECT umpi, strftime(last_date, '%Y-%m-%d') AS last_encounter_date FROM util",
        "pcp_attribution": _with("pcp") + "SELECT * FROM pcp",
        "readmission_30d": _with("adt", "diagnoses") + f""", r AS ({_READMIT}), dx AS (SELECT encounter_id, icd AS primary_dx, row_number() OVER (PARTITION BY encounter_id ORDER BY seq DESC) AS n FROM diagnoses WHERE diagnosis_rank = 1 AND clinical_status = 'active'),
            h AS (SELECT *, event_type = 'A01' AND prior IS NOT NULL AND epoch_us(moment) - epoch_us(prior) <= 2592000000000 AS hit FROM r)
            SELECT sha256(umpi) AS patient_hash, encounter_id, event_type, {_case("event_type", ADT_LABELS)} AS event_label, {_case("event_type", ADT_COARSE)} AS event_category, strftime(moment, {_TS}) AS event_datetime, hit AS is_readmission_30d,
            CASE WHEN hit THEN strftime(date_trunc('day', prior), {_TS}) END AS prior_discharge_datetime, CASE WHEN hit THEN round((epoch_us(moment) - epoch_us(date_trunc('day', prior)::TIMESTAMP)) / 86400000000.0, 6)::DOUBLE END AS days_since_prior_discharge, primary_dx
            FROM h LEFT JOIN dx ON h.encounter_id = dx.encounter_id AND n = 1""".replace("SELECT sha256(umpi) AS patient_hash, encounter_id", "SELECT sha256(umpi) AS patient_hash, h.encounter_id"),
        "event_readmission": f"""WITH adt AS (SELECT event_id, user_id AS umpi, CASE event_type WHEN 'purchase' THEN 'A01' WHEN 'error' THEN 'A03' END AS event_type, ts AS moment FROM events WHERE event_type IN ('purchase', 'error')),
            r AS (SELECT event_id, umpi, event_type, moment, max(CASE WHEN event_type = 'A03' THEN moment END) OVER (PARTITION BY umpi ORDER BY epoch_us(moment) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM adt)
            SELECT event_id, event_type = 'A01' AND prior IS NOT NULL AND epoch_us(moment) - epoch_us(prior) <= 2592000000000 AS is_readmission_30d, CASE WHEN event_type = 'A01' AND epoch_us(moment) - epoch_us(prior) <= 2592000000000 THEN strftime(prior, {_TS}) END AS prior_discharge FROM r""",
        "hba1c_control": _with("patients", "diagnoses", "coded") + f""", ev AS (SELECT umpi, value_quantity, effective, row_number() OVER (PARTITION BY umpi ORDER BY effective DESC, seq) AS n FROM coded WHERE loinc_code = '4548-4' AND year(effective) = {YEAR} AND status = 'final')
            SELECT sha256(p.umpi) AS patient_hash, p.tenant_id, ev.value_quantity < 8.0 AS in_numerator, ev.value_quantity AS evidence_value, strftime(ev.effective, '%Y-%m-%d') AS evidence_date
            FROM patients p LEFT JOIN ev ON p.umpi = ev.umpi AND n = 1 WHERE {YEAR} - year(birth_date) BETWEEN 18 AND 75 AND p.umpi IN (SELECT umpi FROM diagnoses WHERE {_prefix("icd", CHRONIC["DIABETES"])})""",
        "uscdi_gaps": """SELECT 'P' || lpad(c_custkey::VARCHAR, 9, '0') AS umpi, concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN 'name.given' END, CASE WHEN c_custkey % 11 = 0 THEN 'birthDate' END) AS missing_elements, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS qhin_ready FROM customer""",
        "state_metrics": _with("summary") + f"""SELECT '{AS_OF}' AS as_of_date, count(DISTINCT umpi) AS patient_count, count(DISTINCT tenant_id) AS tenant_count, round(avg(charlson_index), 6) AS avg_charlson, sum(encounters_12m)::BIGINT AS encounters, sum(ed_visits_12m)::BIGINT AS ed_visits, sum(inpatient_days_12m)::BIGINT AS inpatient_days,
            count(*) FILTER (has_diabetes) AS diabetes, count(*) FILTER (has_hypertension) AS hypertension, count(*) FILTER (has_chf) AS heart_failure, count(*) FILTER (risk_tier IN ('HIGH', 'VERY_HIGH')) AS high_risk FROM summary""",
        "uscdi_view": _with("summary") + "SELECT patient_hash, tenant_id, gender, age, postal_code, risk_tier, last_encounter_date FROM summary",
        "tenant_view": _with("summary") + "SELECT patient_hash, charlson_index FROM summary WHERE tenant_id = 'TENANT_1'",
        "loinc_map": _with("coded") + "SELECT source_record_id, loinc_code, CASE WHEN loinc_code IS NULL THEN 'UNMAPPED' ELSE 'TERMINOLOGY_SERVICE' END AS normalization_method FROM coded",
        "rxnorm_map": f"SELECT p_partkey, {_case(f'lower({_list(DRUGS)}[(p_partkey % 7)::INT + 1])', RXNORM)} AS rxnorm_code FROM part",
        "snomed_map": _with("diagnoses") + f"SELECT icd AS icd10_code, {_case('icd', SNOMED)} AS snomed_code, count(*) AS n FROM diagnoses GROUP BY 1, 2",
        "unmapped_codes": _with("coded") + "SELECT source_display, 'UNKNOWN' AS source_code, count(*) AS occurrences FROM coded WHERE loinc_code IS NULL GROUP BY 1",
        "normalization_log": _with("coded") + "SELECT source_record_id AS source_id, 'ingest_fhir_bundles' AS source_table, 'clinical_observations' AS target_table, 'LOINC_MAP' AS mapping_type, source_display AS source_value, 'LOCAL' AS source_system, loinc_code AS mapped_value, CASE WHEN loinc_code IS NOT NULL THEN 'http://loinc.org' END AS mapped_system, CASE WHEN loinc_code IS NULL THEN 'UNMAPPED' ELSE 'TERMINOLOGY_SERVICE' END AS mapping_method, (CASE WHEN loinc_code IS NULL THEN 0.0 ELSE 1.0 END)::DOUBLE AS confidence, '1' AS pipeline_version FROM coded",
        "hl7_split": "SELECT floor(o_orderkey / 100)::BIGINT AS batch, count(*) AS messages FROM orders GROUP BY 1",
        "hl7_msh": _with("msgs") + f"SELECT 'MSG' || k AS message_control_id, 'APP' || (k % 3) AS sending_application, CASE WHEN c % 50 = 4 THEN '' ELSE 'FAC' || (k % 6) END AS sending_facility, '2.5.1' AS hl7_version, strftime(moment, {_TS}) AS message_datetime FROM msgs",
        "hl7_ztn": _with("msgs") + "SELECT 'MSG' || k AS message_control_id, CASE WHEN k % 7 <> 0 THEN 'TENANT_' || (c_nationkey % 4) END AS tenant, CASE WHEN k % 7 <> 0 THEN 'SYS' || (k % 2) END AS source, CASE WHEN k % 7 <> 0 THEN 'B1' END AS batch FROM msgs",
        "hl7_tenant": _with("msgs") + f"SELECT {_HL7_TENANT} AS tenant_id, count(*) AS messages FROM msgs GROUP BY 1",
        "hl7_bronze": _with("msgs") + f"SELECT 'MSG' || k AS message_control_id, {_HL7_TENANT} AS tenant_id, CASE WHEN k % 7 <> 0 THEN 'SYS' || (k % 2) ELSE 'APP' || (k % 3) END AS source_system, 'ADT' AS message_type, CASE WHEN a01 THEN 'A01' ELSE 'A03' END AS message_event, 'ADT' AS feed_type, 'PASS' AS validation_status FROM msgs",
        "hl7_dq": _with("msgs") + f"SELECT 'MSG' || k AS source_record_id, error_code, field_path FROM ({_HL7_CODES})",
        "dq_counts": _with("msgs") + f"SELECT error_code, field_path, count(*) AS issue_count FROM ({_HL7_CODES}) GROUP BY 1, 2",
        "fhir_counts": "SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'UNKNOWN' ELSE 'TENANT_' || (c_nationkey % 4) END AS tenant_id, 'transaction' AS bundle_type, 'PASS' AS validation_status, count(*) AS bundles FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
        "bronze_counts": _with("msgs") + f"SELECT CASE WHEN c % 50 = 4 THEN '' ELSE 'FAC' || (k % 6) END AS sending_facility, 'PASS' AS validation_status, 'ADT' AS message_type, CASE WHEN a01 THEN 'A01' ELSE 'A03' END AS message_event, count(*) AS messages, count(*) AS with_tenant FROM msgs GROUP BY ALL",
        "hl7_encounters": _with("msgs") + f"SELECT 'MSG' || k AS message_control_id, 'MRN' || c AS mrn, CASE k % 5 WHEN 0 THEN 'IMP' WHEN 1 THEN 'AMB' WHEN 2 THEN 'EMER' WHEN 3 THEN 'AMB' END AS encounter_class, CASE WHEN a01 THEN 'in-progress' ELSE 'finished' END AS encounter_status, CASE WHEN a01 THEN strftime(moment, {_TS}) END AS period_start, CASE WHEN NOT a01 THEN strftime(moment, {_TS}) END AS period_end, 'FAC' || (k % 6) AS facility, 'ATT-' || (k % 10) AS attending_provider_npi FROM msgs",
        "hl7_conditions": _with("msgs") + f"SELECT 'MSG' || k AS message_control_id, dx AS icd10_code, 'active' AS clinical_status, strftime(moment, {_TS}) AS onset FROM msgs WHERE a01",
        "oru_observations": _with("msgs") + "SELECT 'MSG' || k AS message_control_id, '4548-4' AS source_code, round(4 + k % 50 / 10.0, 1)::DOUBLE AS value_quantity, '%' AS value_unit, 4.0::DOUBLE AS reference_range_low, 5.6::DOUBLE AS reference_range_high, 'H' AS interpretation_code, 'F' AS observation_status FROM msgs WHERE k % 11 = 0",
        "fhir_bundles": _with("msgs") + f"SELECT 'B' || k AS bundle_id, {_FHIR_TENANT} AS tenant_id, 'EHR' || (k % 2) AS source_system, concat_ws(',', CASE WHEN k % 13 = 0 THEN 'Basic' END, CASE WHEN n > 0 THEN 'Condition' END, 'Encounter', CASE WHEN n > 0 THEN 'Observation' END, 'Patient') AS resource_types FROM msgs LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON k = l_orderkey",
        "fhir_resources": _with("msgs") + "SELECT resource_type, supported, count(*) AS n, count(*) FILTER (first) AS with_payload FROM (SELECT 'Patient' AS resource_type, true AS supported, true AS first FROM msgs UNION ALL SELECT 'Encounter', true, false FROM msgs UNION ALL SELECT 'Basic', false, false FROM msgs WHERE k % 13 = 0 UNION ALL SELECT 'Condition', true, false FROM lineitem JOIN msgs ON k = l_orderkey UNION ALL SELECT 'Observation', true, false FROM lineitem JOIN msgs ON k = l_orderkey) GROUP BY 1, 2",
        "fhir_patients": _with("msgs") + "SELECT DISTINCT 'P' || lpad(c::VARCHAR, 9, '0') AS source_id, 'MRN' || c AS source_mrn, 'F' || (c % 97) AS family_name, 'G' || (c % 53) AS given_name, CASE WHEN c % 40 <> 9 THEN strftime(born, '%Y-%m-%d') END AS birth_date, (70000 + c % 500)::VARCHAR AS postal_code FROM msgs",
        "fhir_observations": _with("coded") + f"SELECT source_record_id, umpi, CASE WHEN seq % 10 = 1 THEN '4548-4' ELSE loinc_code END AS loinc_code, CASE WHEN seq % 10 = 1 THEN 'SOURCE_LOINC' WHEN loinc_code IS NULL THEN 'UNMAPPED' ELSE 'TERMINOLOGY_SERVICE' END AS normalization_method, value_quantity, '%' AS value_unit, strftime(effective, {_TS}) AS effective FROM coded",
        "fhir_encounters": _with("msgs") + f"SELECT 'E' || k AS source_record_id, 'P' || lpad(c::VARCHAR, 9, '0') AS umpi, CASE WHEN a01 THEN 'IMP' ELSE 'AMB' END AS encounter_class, strftime(moment, {_TS}) AS period_start, round(k % 9 * 0.5, 6)::DOUBLE AS length_of_stay_hours, 'FAC-' || (k % 6) AS facility_name FROM msgs",
        "fhir_conditions": _with("diagnoses") + "SELECT 'C' || seq AS source_record_id, umpi, icd AS icd10_code, clinical_status, 'primary' AS condition_category FROM diagnoses",
        "fhir_dq": _with("msgs") + "SELECT 'FHIR_MISSING_TENANT' AS error_code, 'B' || k AS source_record_id FROM msgs WHERE k % 17 = 0 UNION ALL SELECT 'FHIR_MISSING_BIRTH_DATE', 'B' || k || '/P' || lpad(c::VARCHAR, 9, '0') FROM msgs WHERE c % 40 = 9",
        "csv_patients": _with("csvp") + "SELECT 'PT' || c AS source_mrn, CASE WHEN c % 25 <> 3 THEN 'G' || (c % 53) END AS given_name, CASE WHEN c % 25 <> 4 THEN 'F' || (c % 97) END AS family_name, CASE WHEN c % 20 <> 5 THEN strftime(born, '%Y-%m-%d') END AS birth_date, c || ' Main St, Apt 1' AS address_line, 'Tulsa' AS city, CASE WHEN c % 60 <> 8 THEN (70000 + c % 500)::VARCHAR END AS postal_code FROM csvp",
        "csv_conditions": _with("csvp") + "SELECT 'PT' || c AS source_record_id, dx AS icd10_code, 'active' AS clinical_status, count(*) AS n FROM csvp GROUP BY ALL",
        "csv_labs": _with("labs") + f"SELECT 'R' || seq AS source_record_id, CASE WHEN seq % 41 = 0 THEN 'UNKNOWN' ELSE 'U' || o_custkey END AS umpi, CASE WHEN seq % 3 = 0 THEN '4548-4' ELSE {_case('lower(trim(test_name))', LOINC)} END AS loinc_code, CASE WHEN result_value <> 'POSITIVE' THEN result_value::DOUBLE END AS value_quantity, CASE WHEN result_value = 'POSITIVE' THEN result_value END AS value_string, strftime(l_shipdate, '%Y-%m-%d') AS effective FROM labs",
        "csv_dq_bronze": _with("csvp") + f"SELECT row_idx || ':PT' || c AS source_record_id, error_code, field_path FROM ({_CSV_DQ})",
        "csv_dq_silver": _with("csvp") + f"""SELECT error_code, field_path, count(*) AS issue_count FROM (SELECT 'CSV_BLANK_NAME' AS error_code, 'first_name' AS field_path FROM csvp WHERE c % 25 = 3 UNION ALL SELECT 'CSV_BLANK_NAME', 'last_name' FROM csvp WHERE c % 25 = 4 UNION ALL SELECT 'CSV_MALFORMED_DOB', 'dob' FROM csvp WHERE c % 20 = 5
            UNION ALL SELECT 'CSV_DUPLICATE_ROW', 'patient_id' FROM csvp WHERE again = 1 UNION ALL SELECT 'CSV_INVALID_ICD10', 'primary_dx_icd10' FROM csvp WHERE {_case("dx", SNOMED)} IS NULL) GROUP BY 1, 2""",
        "csv_lab_dq": _with("labs") + f"SELECT error_code, count(*) AS issue_count FROM (SELECT 'CSV_TEXT_RESULT_VALUE' AS error_code FROM labs WHERE result_value = 'POSITIVE' UNION ALL SELECT 'CSV_UNMAPPED_LAB_CODE' FROM labs WHERE seq % 3 <> 0 AND {_case('lower(trim(test_name))', LOINC)} IS NULL) GROUP BY 1",
        "csv_duplicates": _with("csvp") + "SELECT 'PT' || c AS patient_id, max(row_idx) AS row_idx, min(row_idx) AS first_row_idx FROM csvp GROUP BY c HAVING count(*) > 1",
        "csv_audit": _with("csvp") + f"SELECT 'patients.csv' AS file_name, (SELECT count(*) FROM csvp) AS row_count, count(*) AS error_count, 'ERROR' AS validation_status FROM ({_CSV_DQ})",
        "csv_payload": _with("csvp") + "SELECT 'PT' || c AS source_mrn, c || ' Main St, Apt 1' AS address_line, count(*) AS n FROM csvp GROUP BY ALL",
        "audit_log": _with("msgs") + "SELECT 'FAC' || (k % 6) AS facility, count(*) AS record_count, count(*) FILTER (c % 50 NOT IN (1, 2, 3, 4)) AS pass_count, count(*) FILTER (c % 50 IN (1, 2, 3, 4)) AS error_count FROM msgs GROUP BY 1",
        "mpi_resolve": _with("patients") + f"SELECT source_id, umpi, match_method, match_confidence, is_new_record FROM ({_MPI})",
        "mpi_crosswalk": _with("patients") + f"SELECT umpi, count(*) AS records, count(DISTINCT substr(source_id, 1, 1)) AS systems FROM ({_MPI}) GROUP BY 1",
        "mpi_index": _with("patients") + f"SELECT umpi, tenant_id, family_name, given_name, 1 AS linked_record_count FROM ({_MPI}) WHERE is_new_record",
        "dq_scorecard": _with("patients", "coded", "diagnoses") + f""", o AS (SELECT tenant_id, round(100.0 * count(loinc_code) / count(*), 4)::DOUBLE AS pct_loinc_coverage, count(*) - count(loinc_code) AS unmapped_code_count FROM coded GROUP BY 1), d AS (SELECT tenant_id, round(100.0 * count(*) FILTER (regexp_matches(icd, '^[A-Z][0-9]')) / count(*), 4)::DOUBLE AS pct_icd10_coverage FROM diagnoses GROUP BY 1),
            p AS (SELECT tenant_id, count(*) AS patient_count, 100.0::DOUBLE AS pct_complete_demographics, 50.0::DOUBLE AS mpi_match_rate FROM patients GROUP BY 1) SELECT * FROM p LEFT JOIN o USING (tenant_id) LEFT JOIN d USING (tenant_id)""",
        "patient_observation_preview": _with("patients", "coded") + f"SELECT p.umpi, family_name, source_display, value_quantity, strftime(effective, {_TS}) AS effective FROM patients p LEFT JOIN coded o ON p.umpi = o.umpi",
        "union_conditions": _with("diagnoses", "msgs") + "SELECT source, icd10_code, count(*) AS n FROM (SELECT 'FHIR' AS source, icd AS icd10_code FROM diagnoses UNION ALL SELECT 'HL7', dx FROM msgs WHERE a01) GROUP BY 1, 2",
        **faults.sql(_with("labs")),
        **written.sql(_with("msgs"), _with("csvp"), _with("summary"), _HL7_TENANT, _FHIR_TENANT),
    }
