"""Queries over faulty and unusual inputs, each with its SQL form: broken messages and bundles, two CSV files, every
identity pass, stored persons. Rows get their case from their key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions.columns import one_decimal
from carelattice.operators import csvbatch, dq, fhir, governance, hl7, identity, terminology

from . import fixtures as fx

_TS = "'%Y-%m-%d %H:%M:%S'"
#: Message times and birth dates by case; of the first eight days, four are only read leniently.
TIMES = ("20010315101530", "20010231101500", "200103151015", "20010315101530-0500", "abc", "", "20010315", "20010315101530")
BORN = ("19871350", "20001499", "98989898", "20171732", "unclear", "", "19580412", "20010000")


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _text(c: Column, *around: str) -> Column:
    return F.concat(F.lit(around[0]), c.cast("string"), F.lit(around[1] if len(around) > 1 else ""))


def _orders(s: SparkSession, d: str) -> DataFrame:
    return fx.base(s, d, "orders").select(F.col("o_orderkey").alias("arrival_seq"))


def messages(s: SparkSession, d: str) -> DataFrame:
    """No MSH line (0 modulo 9), `#` as separator (1), else usual; times and birth dates by the key modulo 8."""
    k = F.col("arrival_seq")
    at = fx.pick(TIMES, k % 8)
    header = F.concat_ws("|", F.lit("MSH|^~\\&|APP||HUB|STATE"), at, F.lit("|ADT^A01"), _text(k, "MSG"), F.lit("P|2.5.1"))
    header = F.when(k % 9 == 1, F.translate(header, "|", "#")).otherwise(header)
    body = F.concat(F.lit("EVN|A01|"), at, F.lit("\rPID|1||M^^^F1||A^B||"), fx.pick(BORN, k % 8), F.lit("|F"))
    return _orders(s, d).withColumn("raw_message", F.when(k % 9 == 0, body).otherwise(F.concat_ws("\r", header, body)))


def _adt(s: SparkSession, d: str) -> DataFrame:
    return hl7.parse_adt(hl7.parse_messages(messages(s, d)))


def hl7_faults(s: SparkSession, d: str) -> DataFrame:
    return _adt(s, d).select("arrival_seq", "message_control_id", "tenant_id", "message_type", "validation_status", "error", _time("message_datetime").alias("message_time"), _time("event_datetime").alias("event_time"))


def hl7_fault_findings(s: SparkSession, d: str) -> DataFrame:
    """Both readings of birth dates."""
    modes = [F.struct(F.lit(name).alias("mode"), dq.found(dq.hl7_rules(lenient=lenient)).alias("found")) for name, lenient in (("strict", False), ("lenient", True))]
    rows = _adt(s, d).select("arrival_seq", F.explode(F.array(*modes)).alias("m")).select("arrival_seq", "m.*")  # one parse for both
    return dq.findings(rows, "found", "arrival_seq", ["mode"]).select("mode", "source_record_id", "error_code", "error_severity", "field_path", F.length("raw_value").alias("raw_length"))


def bundles(s: SparkSession, d: str) -> DataFrame:
    """No JSON (0 modulo 7), no Bundle (1), no id (2), a null birth date (3), none (4), a tag without a code (5), usual (6)."""
    k = F.col("arrival_seq")
    tag = F.when(k % 7 == 5, f'{{"system":"{fhir.TENANT_TAG}"}}').otherwise(f'{{"system":"{fhir.TENANT_TAG}","code":"T1"}}')
    born = F.when(k % 7 == 3, ',"birthDate":null').when(k % 7 == 4, "").otherwise(',"birthDate":"1958-04-12"')
    name = F.when(k % 7 == 2, "").otherwise(_text(k, '"id":"B', '",'))
    whole = F.concat(F.lit('{"resourceType":"Bundle",'), name, F.lit('"type":"batch","meta":{"tag":['), tag, F.lit(']},"entry":[{"resource":{"resourceType":"Patient"'), _text(k, ',"id":"p', '"'), born, F.lit('}},{"resource":{"resourceType":"Basic"}}]}'))
    return _orders(s, d).withColumn("raw_bundle", F.when(k % 7 == 0, _text(k, "{bad")).when(k % 7 == 1, _text(k, '{"resourceType":"Patient","id":"q', '"}')).otherwise(whole))


def fhir_faults(s: SparkSession, d: str) -> DataFrame:
    rows = fhir.resources(fhir.parse_bundles(bundles(s, d)))
    return rows.select("arrival_seq", F.when(F.col("arrival_seq") % 7 != 2, F.when(F.col("arrival_seq") % 7 != 0, F.col("bundle_id"))).alias("bundle_id"), "bundle_type", "tenant_id", "validation_status", "error", "entry_index", "resource_type", "supported", F.col("bundle_payload").isNotNull().alias("with_payload"))


def fhir_fault_findings(s: SparkSession, d: str) -> DataFrame:
    return dq.fhir_findings(fhir.parse_bundles(bundles(s, d))).groupBy("error_code", "error_severity", "tenant_id").agg(F.count("*").alias("n"))


_LOINC_A, _LOINC_B, _LOCAL = ('{"system":"http://loinc.org","code":"4548-4"}', '{"system":"http://loinc.org","code":"2345-7","display":"Glucose"}', '{"system":"urn:local","code":"L1","display":"hba1c"}')
#: Parts of an Observation by case: its code and its value, range, interpretation and time.
OBSERVATIONS = (
    ('{"text":"HbA1c"}', '"valueString":"POSITIVE","effectiveDateTime":"2001-03-15"'),
    (f'{{"coding":[{_LOINC_A},{_LOCAL},{_LOINC_B}],"text":"sugar"}}', '"valueQuantity":{"value":7.25,"unit":"percent","code":"%"},"valueString":"no","effectiveDateTime":"2001-03-15T10:15:30+02:00"'),
    (f'{{"coding":[{_LOCAL}]}}', '"valueQuantity":{"value":6.5,"unit":"percent","code":""},"issued":"2001-03-16T01:02:03Z"'),
    ('{"text":"mystery"}', '"referenceRange":[{"low":{"value":4,"unit":"%"},"high":{"value":5.6,"unit":"mg"}},{"low":{"value":9}}],"interpretation":[{"coding":[{"code":"H","display":"High"},{"code":"HH"}]}]'),
    ("{}", '"referenceRange":[{"high":{"value":5.6,"unit":"mg"}}],"interpretation":[{"text":"high"}]'),
)


def _observations(s: SparkSession, d: str) -> DataFrame:
    k = F.col("arrival_seq")
    part = lambda i: fx.pick([o[i] for o in OBSERVATIONS], k % 5)
    text = F.concat(F.lit('{"resourceType":"Bundle","id":"b","entry":[{"resource":{"resourceType":"Observation","id":"'), k.cast("string"), F.lit('","code":'), part(0), F.lit(","), part(1), F.lit("}}]}"))
    return terminology.normalize_observations(fhir.observations(fhir.resources(fhir.parse_bundles(_orders(s, d).withColumn("raw_bundle", text)))))


def fhir_values(s: SparkSession, d: str) -> DataFrame:
    return _observations(s, d).select("source_record_id", "loinc_code", "normalization_method", "source_code", "source_code_system", "source_display", "value_quantity", "value_string", "value_unit", "reference_range_low", "reference_range_high", "reference_range_unit", "interpretation_code", "interpretation_display", _time("effective_datetime").alias("effective"))


def fhir_value_log(s: SparkSession, d: str) -> DataFrame:
    """One entry for each LOINC coding."""
    return terminology.normalization_log(_observations(s, d)).select(F.col("source_id").alias("source_record_id"), "mapping_type", "source_value", "source_system", F.col("mapped_value").alias("target_code"), "mapped_system", F.col("mapping_method").alias("normalization_method"), F.col("mapping_confidence").alias("confidence"))


def _two_files(s: SparkSession, d: str) -> DataFrame:
    """Customers dealt to two files; four in a row share a patient id, blank for every 31st."""
    c = F.col("c_custkey")
    rows = fx.base(s, d, "customer").select(F.when(c % 2 == 0, "a.csv").otherwise("b.csv").alias("file_name"), c.alias("row_idx"), F.when(c % 31 == 0, " ").otherwise(_text(F.floor(c / 4), "PT")).alias("patient_id"))
    fixed = {"first_name": "G", "last_name": "F", "dob": "1958-04-12", "zip": "70001", "primary_dx_icd10": "I21.9"}
    return rows.select("*", *(F.lit(fixed.get(x, "")).alias(x) for x in csvbatch.PATIENT_COLUMNS if x != "patient_id"))


def csv_two_files(s: SparkSession, d: str) -> DataFrame:
    rows = _two_files(s, d)
    stage = lambda found, name: found.select(F.lit(name).alias("stage"), "file_name", "source_record_id", "error_code", "error_severity", "raw_value")
    return stage(dq.csv_bronze_findings(rows, "patients"), "bronze").unionByName(stage(dq.csv_silver_findings(rows), "silver"))


def csv_lab_dq_bronze(s: SparkSession, d: str) -> DataFrame:
    return dq.csv_bronze_findings(fx.lab_rows(s, d), "labs").select("source_record_id", "error_code", "error_severity", "field_path", "raw_value")


def mpi_passes(s: SparkSession, d: str) -> DataFrame:
    """Three records for each customer: a new one, one that meets it in the pass of the key modulo 4, and one that every third time is a stored person's."""
    c = F.col("c_custkey")
    n = 1_000_000_000
    people = fx.base(s, d, "customer").select(c.cast("string").alias("x"), c, (c % 4).alias("i"), F.date_add(F.lit(fx.AS_OF), (-c % 20000).cast("int")).alias("birth_date"))
    x, i = F.col("x"), F.col("i")
    own = lambda prefix: F.concat(F.lit(prefix), x)
    row = lambda seq, mrn, npi, system, ssn, name, given, post: people.select((c + seq).alias("arrival_seq"), mrn.alias("source_mrn"), npi.alias("source_facility_npi"), system.alias("source_identifier_system"), ssn.alias("ssn_last4"), name.alias("family_name"), given.alias("given_name"), post.alias("postal_code"), "birth_date")
    first = row(0, own("M"), F.lit("N1"), F.lit("S1"), F.lit("1234"), own("Fam "), F.lit("Ann"), F.lit("70001"))
    same = lambda when, a, b: F.when(when, a).otherwise(b)
    second = row(n, same(i <= 1, own(" M"), own("Q")), same(i == 0, F.lit("N1 "), F.lit("N2")), same(i == 1, F.lit(" S1"), F.lit("S2")), same(i == 2, F.lit("1234"), F.lit(None).cast("string")), same(i >= 2, own(" fam   "), own("Else ")), same(i == 3, F.lit("ANN"), F.lit("Bea")), F.lit("70001"))
    third = row(2 * n, own("Z"), same(c % 3 == 0, F.lit("N9"), F.lit("N8")), F.lit("S9"), F.lit(None).cast("string"), own("Third "), F.lit("Cy"), F.lit("70002"))
    seeds = people.select(c.alias("seq"), own("SEED").alias("umpi"), own("Z").alias("source_mrn"), F.lit("N9").alias("source_facility_npi"))
    return identity.resolve(first.unionByName(second.withColumn("source_mrn", F.trim("source_mrn"))).unionByName(third), seeds=seeds).select("arrival_seq", "umpi", "match_method", "match_confidence", "is_new_record", F.array_join("matched_on", ",").alias("matched_on"))


def hba1c_rounding(s: SparkSession, d: str) -> DataFrame:
    value = (F.col("arrival_seq") % 4001 / 100.0).cast("double")
    return _orders(s, d).select("arrival_seq", one_decimal(value).alias("evidence_value"))


def tenant_rows(s: SparkSession, d: str) -> DataFrame:
    """What an operator, one tenant and nobody see of patients, with social security numbers cut."""
    people = governance.last_four(fx.patients(s, d).withColumn("ssn", _text(F.col("arrival_seq") % 90 + 10, "123-45-67")), "ssn")
    views = [governance.tenant_view(people, t, o).withColumn("role", F.lit(r)) for r, t, o in (("operator", None, True), ("tenant", "TENANT_1", False), ("nobody", None, False))]
    return views[0].unionByName(views[1]).unionByName(views[2]).groupBy("role", "tenant_id", "ssn").agg(F.count("*").alias("patients"))


def hl7_birth_dates(s: SparkSession, d: str) -> DataFrame:
    """Birth dates of messages as stored, and the finding's words for those that can't be read."""
    # what was found stands with its message, so nothing is joined
    found = F.get(F.filter(dq.found(dq.hl7_rules()), lambda f: f["error_code"] == "HL7_MALFORMED_DOB"), F.lit(0))
    return _adt(s, d).select("arrival_seq", F.date_format("birth_date", "yyyy-MM-dd").alias("birth_date"), "mrn", "gender", F.explode(F.array(found)).alias("f")).select("arrival_seq", "birth_date", "mrn", "gender", "f.error_message", "f.error_severity")


def csv_long_values(s: SparkSession, d: str) -> DataFrame:
    """Findings on values of some thousand characters, which are shown in part."""
    rows = fx.csv_raw(s, d).filter("row_idx < 1000000000").withColumn("dob", F.repeat(F.lit("19/"), (F.col("row_idx") % 1500).cast("int")))
    found = dq.csv_bronze_findings(rows, "patients").filter("error_code in ('CSV_MALFORMED_DOB', 'CSV_DUPLICATE_RECORD')")
    return found.select("source_record_id", "error_code", "error_message", F.length("raw_value").alias("shown"))


def index_fill(s: SparkSession, d: str) -> DataFrame:
    """Patients as stored: what a later record lacks comes from the index, and its birth date always does."""
    people = fx.patients(s, d)
    k = F.col("arrival_seq")
    later = people.select("umpi", F.when(k % 2 == 0, F.col("given_name")).alias("given_name"), F.when(k % 3 == 0, F.lit("Other")).otherwise(F.when(k % 3 == 1, F.lit(""))).alias("family_name"), F.lit(fx.AS_OF).alias("birth_date"), F.when(k % 5 == 0, F.col("gender")).alias("gender"), F.when(k % 7 == 0, F.lit("99999")).alias("postal_code"))
    index = people.select("umpi", "given_name", "family_name", "birth_date", "gender", "postal_code").filter(k % 11 != 0)
    return identity.filled(later, index).withColumn("birth_date", F.date_format("birth_date", "yyyy-MM-dd"))


_ALL = (hl7_birth_dates, csv_long_values, index_fill, hl7_faults, hl7_fault_findings, fhir_faults, fhir_fault_findings, fhir_values, fhir_value_log, csv_two_files, csv_lab_dq_bronze, mpi_passes, hba1c_rounding, tenant_rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def _by(key: str, values: list[str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def sql(labs: str) -> dict[str, str]:
    """labs: the WITH clause of the laboratory rows."""
    moments = ["TIMESTAMP '2001-03-15 10:15:30'", "NULL", "TIMESTAMP '2001-03-15 10:15:00'", "TIMESTAMP '2001-03-15 10:15:30'", "NULL", "NULL", "TIMESTAMP '2001-03-15'", "TIMESTAMP '2001-03-15 10:15:30'"]
    events = [*moments[:2], "TIMESTAMP '2001-03-15'", *moments[3:]]
    k = "o_orderkey"
    bad = "IN (0, 1, 2, 3, 4, 7)"
    born = _by(f"{k} % 8", [str(len(b)) for b in BORN])
    per_dup = "SELECT *, count(*) OVER (PARTITION BY file_name, id ORDER BY c) AS nth FROM files"
    return {
        "hl7_faults": f"""SELECT {k} AS arrival_seq, CASE WHEN {k} % 9 <> 0 THEN 'MSG' || {k} END AS message_control_id, 'UNKNOWN' AS tenant_id, CASE WHEN {k} % 9 <> 0 THEN 'ADT' END AS message_type,
            CASE WHEN {k} % 9 = 0 THEN 'ERROR' ELSE 'PASS' END AS validation_status, CASE WHEN {k} % 9 = 0 THEN 'No MSH segment found' END AS error,
            CASE WHEN {k} % 9 <> 0 THEN strftime({_by(f"{k} % 8", moments)}, {_TS}) END AS message_time, strftime({_by(f"{k} % 8", events)}, {_TS}) AS event_time FROM orders""",
        "hl7_birth_dates": f"""SELECT {k} AS arrival_seq, CASE WHEN {k} % 8 = 6 THEN '1958-04-12' END AS birth_date, 'M' AS mrn, 'F' AS gender, CASE WHEN {k} % 9 <> 0 AND {k} % 8 {bad} THEN 'Birth date can''t be read' END AS error_message, CASE WHEN {k} % 9 <> 0 AND {k} % 8 {bad} THEN 'ERROR' END AS error_severity FROM orders""",
        "csv_long_values": "SELECT c_custkey || ':PT' || c_custkey AS source_record_id, 'CSV_MALFORMED_DOB' AS error_code, 'Expected YYYY-MM-DD' AS error_message, least(2000, 3 * (c_custkey % 1500)) AS shown FROM customer WHERE c_custkey % 1500 > 0",
        "index_fill": """SELECT 'P' || lpad(c::VARCHAR, 9, '0') AS umpi, CASE WHEN c % 2 = 0 OR c % 11 <> 0 THEN 'G' || (c % 53) END AS given_name, CASE WHEN c % 3 = 0 THEN 'Other' WHEN c % 11 <> 0 THEN 'F' || (c % 97) END AS family_name,
            CASE WHEN c % 11 <> 0 THEN strftime(DATE '1930-01-01' + (c * 7919 % 27000)::INT, '%Y-%m-%d') END AS birth_date, CASE WHEN c % 5 = 0 OR c % 11 <> 0 THEN CASE WHEN c % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
            CASE WHEN c % 7 = 0 THEN '99999' WHEN c % 11 <> 0 THEN (70000 + c % 500)::VARCHAR END AS postal_code FROM (SELECT c_custkey AS c FROM customer)""",
        "hl7_fault_findings": f"""SELECT mode, {k}::VARCHAR AS source_record_id, error_code, 'ERROR' AS error_severity, field_path, raw_length FROM (SELECT {k}, unnest(['strict', 'lenient']) AS mode FROM orders), LATERAL (
            SELECT 'HL7_PARSE_FAILURE' AS error_code, 'MSH' AS field_path, length('EVN|A01|' || {_by(f"{k} % 8", [f"'{t}'" for t in TIMES])} || chr(13) || 'PID|1||M^^^F1||A^B||' || '|F') + {born} AS raw_length WHERE {k} % 9 = 0
            UNION ALL SELECT 'HL7_MISSING_MSH4', 'MSH-4', NULL WHERE {k} % 9 <> 0
            UNION ALL SELECT 'HL7_MALFORMED_DOB', 'PID-7', {born} WHERE {k} % 9 <> 0 AND (mode = 'strict' AND {k} % 8 {bad} OR mode = 'lenient' AND {k} % 8 IN (4, 7)))""",
        "fhir_faults": f"""SELECT {k} AS arrival_seq, CASE {k} % 7 WHEN 0 THEN NULL WHEN 2 THEN NULL WHEN 1 THEN 'q' || {k} ELSE 'B' || {k} END AS bundle_id, CASE WHEN {k} % 7 < 2 THEN 'unknown' ELSE 'batch' END AS bundle_type,
            CASE WHEN {k} % 7 IN (0, 1, 5) THEN 'UNKNOWN' ELSE 'T1' END AS tenant_id, CASE WHEN {k} % 7 < 2 THEN 'ERROR' ELSE 'PASS' END AS validation_status, CASE {k} % 7 WHEN 0 THEN 'Invalid JSON or no resource type' WHEN 1 THEN 'Expected Bundle, got Patient' END AS error,
            i AS entry_index, CASE WHEN {k} % 7 < 2 THEN 'UNKNOWN' WHEN i = 0 THEN 'Patient' ELSE 'Basic' END AS resource_type, {k} % 7 < 2 OR i = 0 AS supported, i = 0 AS with_payload FROM orders, (VALUES (0), (1)) v(i) WHERE i = 0 OR {k} % 7 >= 2""",
        "fhir_fault_findings": f"SELECT * FROM (SELECT CASE WHEN {k} % 7 < 2 THEN 'FHIR_PARSE_FAILURE' ELSE 'FHIR_MISSING_BIRTH_DATE' END AS error_code, CASE WHEN {k} % 7 < 2 THEN 'ERROR' ELSE 'WARNING' END AS error_severity, CASE WHEN {k} % 7 < 2 THEN 'UNKNOWN' ELSE 'T1' END AS tenant_id, count(*) AS n FROM orders WHERE {k} % 7 IN (0, 1, 4) GROUP BY ALL)",
        "fhir_values": f"""SELECT {k}::VARCHAR AS source_record_id, {_by(f"{k} % 5", ["'4548-4'", "'2345-7'", "'4548-4'"])} AS loinc_code, {_by(f"{k} % 5", ["'TERMINOLOGY_SERVICE'", "'SOURCE_LOINC'", "'TERMINOLOGY_SERVICE'", "'UNMAPPED'", "'UNMAPPED'"])} AS normalization_method,
            CASE WHEN {k} % 5 IN (1, 2) THEN 'L1' END AS source_code, CASE WHEN {k} % 5 IN (1, 2) THEN 'urn:local' END AS source_code_system, {_by(f"{k} % 5", ["'HbA1c'", "'sugar'", "'hba1c'", "'mystery'"])} AS source_display,
            ({_by(f"{k} % 5", ["NULL", "7.25", "6.5"])})::DOUBLE AS value_quantity, CASE WHEN {k} % 5 = 0 THEN 'POSITIVE' END AS value_string, {_by(f"{k} % 5", ["NULL", "'%'", "'percent'"])} AS value_unit,
            CASE WHEN {k} % 5 = 3 THEN 4.0::DOUBLE END AS reference_range_low, CASE WHEN {k} % 5 >= 3 THEN 5.6::DOUBLE END AS reference_range_high, CASE {k} % 5 WHEN 3 THEN '%' WHEN 4 THEN 'mg' END AS reference_range_unit,
            CASE WHEN {k} % 5 = 3 THEN 'H' END AS interpretation_code, CASE WHEN {k} % 5 = 3 THEN 'High' END AS interpretation_display, {_by(f"{k} % 5", ["'2001-03-15 00:00:00'", "'2001-03-15 10:15:30'", "'2001-03-16 01:02:03'"])} AS effective FROM orders""",
        "fhir_value_log": f"""SELECT {k}::VARCHAR AS source_record_id, 'LOINC_MAP' AS mapping_type, e.v AS source_value, e.s AS source_system, e.c AS target_code, CASE WHEN e.c IS NOT NULL THEN 'http://loinc.org' END AS mapped_system,
            {_by(f"{k} % 5", ["'TERMINOLOGY_SERVICE'", "'SOURCE_LOINC'", "'TERMINOLOGY_SERVICE'", "'UNMAPPED'", "'UNMAPPED'"])} AS normalization_method, (CASE WHEN {k} % 5 < 3 THEN 1 ELSE 0 END)::DOUBLE AS confidence
            FROM (SELECT {k}, unnest({_by(f"{k} % 5", ["[{'v': 'HbA1c', 's': 'LOCAL', 'c': '4548-4'}]", "[{'v': '4548-4', 's': 'http://loinc.org', 'c': '4548-4'}, {'v': '2345-7', 's': 'http://loinc.org', 'c': '2345-7'}]", "[{'v': 'hba1c', 's': 'urn:local', 'c': '4548-4'}]", "[{'v': 'mystery', 's': 'LOCAL', 'c': NULL}]", "[{'v': NULL, 's': 'LOCAL', 'c': NULL}]"])}) AS e FROM orders)""",
        "csv_two_files": f"""WITH files AS (SELECT c_custkey AS c, CASE WHEN c_custkey % 2 = 0 THEN 'a.csv' ELSE 'b.csv' END AS file_name, CASE WHEN c_custkey % 31 = 0 THEN ' ' ELSE 'PT' || (c_custkey // 4) END AS id FROM customer), n AS ({per_dup})
            SELECT stage, file_name, c || ':' || id AS source_record_id, CASE WHEN id = ' ' THEN 'CSV_MISSING_REQUIRED_FIELD' WHEN stage = 'bronze' THEN 'CSV_DUPLICATE_RECORD' ELSE 'CSV_DUPLICATE_ROW' END AS error_code, CASE WHEN stage = 'bronze' THEN 'ERROR' ELSE 'WARNING' END AS error_severity,
            CASE WHEN id <> ' ' THEN id END AS raw_value FROM n, (VALUES ('bronze'), ('silver')) v(stage) WHERE id = ' ' AND stage = 'bronze' OR id <> ' ' AND nth > 1""",
        "csv_lab_dq_bronze": labs + """SELECT seq || ':R' || seq AS source_record_id, CASE WHEN result_value IS NULL THEN 'CSV_MISSING_REQUIRED_FIELD' ELSE 'CSV_NON_NUMERIC_RESULT' END AS error_code, CASE WHEN result_value IS NULL THEN 'ERROR' ELSE 'WARNING' END AS error_severity,
            'result_value' AS field_path, result_value AS raw_value FROM labs WHERE result_value IS NULL OR result_value = 'POSITIVE'""",
        "mpi_passes": """SELECT c_custkey + part * 1000000000 AS arrival_seq, CASE WHEN part = 0 OR part = 1 THEN sha256('umpi~' || c_custkey) WHEN c_custkey % 3 = 0 THEN 'SEED' || c_custkey ELSE sha256('umpi~' || (c_custkey + 2000000000)) END AS umpi,
            CASE WHEN pass = -1 THEN 'NEW_RECORD' ELSE ['MRN_NPI', 'IDENTIFIER_SYSTEM', 'SSN4_DOB_NAME', 'DOB_NAME_ZIP'][pass + 1] END AS match_method, (CASE pass WHEN -1 THEN 0 WHEN 3 THEN 0.95 ELSE 1 END)::DOUBLE AS match_confidence, pass = -1 AS is_new_record,
            CASE WHEN pass = -1 THEN '' ELSE ['source_mrn,source_facility_npi', 'source_identifier_system,source_mrn', 'ssn_last4,birth_date,family_name', 'birth_date,family_name,given_name,postal_code'][pass + 1] END AS matched_on
            FROM (SELECT c_custkey, part, (CASE WHEN part = 1 THEN c_custkey % 4 WHEN part = 2 AND c_custkey % 3 = 0 THEN 0 ELSE -1 END)::INT AS pass FROM customer, (VALUES (0), (1), (2)) v(part))""",
        "hba1c_rounding": f"SELECT {k} AS arrival_seq, format('{{:.1f}}', ({k} % 4001)::DOUBLE / 100.0::DOUBLE)::DOUBLE AS evidence_value FROM orders",
        "tenant_rows": """SELECT role, tenant_id, ssn, count(*) AS patients FROM (SELECT 'TENANT_' || (c_nationkey % 4) AS tenant_id, '67' || (c_custkey % 90 + 10) AS ssn FROM customer), (VALUES ('operator'), ('tenant'), ('nobody')) v(role)
            WHERE role = 'operator' OR role = 'tenant' AND tenant_id = 'TENANT_1' GROUP BY ALL""",
    }
