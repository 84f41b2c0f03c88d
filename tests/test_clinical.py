"""Behaviour of the clinical operators on pinned cases."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from carelattice.functions.columns import one_decimal
from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.functions.codes import CHARLSON, LOINC, RXNORM, SNOMED
from carelattice.operators import csvbatch, dq, fhir, gold, governance, hl7, identity, terminology
from carelattice.schemas import LAYERS, TABLES
from carelattice.sources.files import split_bundles, split_messages

ADT = "MSH|^~\\&|EPIC|WESTFAC|HUB|STATE|20240315082301||ADT^A01^ADT_A01|MSG1|P|2.5.1\rEVN|A01|20240315082000\rPID|1||MRN1^^^WESTFAC^MR~XXXXX1234^^^X^SS||Alvarez^Elena^L||19580412|F\rPV1|1|I|ICU^1^2^WESTFAC||||ATT-NPI-77^Lee\rDG1|1||I21.9^MI^ICD10\rZTN|TENANT_ID=WEST_CLINIC|SOURCE_SYSTEM=EPIC_1|FEED_TYPE=ADT"


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(("raw", "expected"), [("20240315082301", dt.datetime(2024, 3, 15, 8, 23, 1)), ("20240315", dt.datetime(2024, 3, 15)), ("202403150823", dt.datetime(2024, 3, 15, 8, 23)), ("20240315082301+0500", dt.datetime(2024, 3, 15, 8, 23, 1)), ("", None), (None, None), ("19991399", None), ("junk", None)])
def test_hl7_timestamp(spark, raw, expected):
    assert one(spark, raw, c.hl7_timestamp) == expected


@pytest.mark.parametrize(("raw", "expected"), [("20241115", dt.datetime(2024, 1, 1, 1, 5)), ("19761204", dt.datetime(1976, 1, 2, 0, 4)), ("20240315", dt.datetime(2024, 3, 15)), ("00000000", None)])
def test_lenient_timestamp(spark, raw, expected):
    assert one(spark, raw, lambda v: c.hl7_timestamp(v, lenient=True)) == expected


@pytest.mark.parametrize(("raw", "expected"), [("1.5", 1.5), ("1_0", 10.0), (" 7 ", 7.0), ("1.5d", None), ("POSITIVE", None), ("", None), ("-.5e1", -5.0)])
def test_to_float(spark, raw, expected):
    assert one(spark, raw, c.to_float) == expected


@pytest.mark.parametrize(("birth", "at", "years"), [("1958-04-12", "2024-04-11", 65), ("1958-04-12", "2024-04-12", 66), ("2000-02-29", "2001-02-28", 0), ("2000-02-29", "2001-03-01", 1)])
def test_age(spark, birth, at, years):
    assert one(spark, birth, lambda v: c.age(v.cast("date"), F.lit(at).cast("date"))) == years


def test_prefixes_and_names(spark):
    assert c.minimal_prefixes(["E11", "E11.2", "E10", "E1"]) == ["E1"]
    assert one(spark, "\t van  der\nBerg ", c.normal_name) == "VAN DER BERG"
    assert one(spark, "  ", c.normal_name) is None
    assert one(spark, "a~1", c.hash_umpi) == __import__("hashlib").sha256(b"a~1").hexdigest()


def test_hl7_message(spark):
    df = spark.createDataFrame([(ADT,), ("just some words",), (ADT.split("\rZTN")[0],)], "raw_message string")
    good, bad, plain = hl7.parse_messages(df).collect()
    assert (good.tenant_id, good.source_system, good.feed_type, good.message_type, good.message_event, good.validation_status) == ("WEST_CLINIC", "EPIC_1", "ADT", "ADT", "A01", "PASS")
    assert good.message_datetime == dt.datetime(2024, 3, 15, 8, 23, 1) and good.raw_message == ADT
    assert (bad.validation_status, bad.tenant_id, bad.raw_message) == ("ERROR", "UNKNOWN", "just some words") and bad.error
    assert plain.tenant_id == "WESTFAC"
    assert hl7.parse_messages(df, "DEFAULT").collect()[2].tenant_id == "DEFAULT"
    adt = hl7.parse_adt(hl7.parse_messages(df)).first()
    assert (adt.mrn, adt.family_name, adt.given_name, adt.birth_date, adt.encounter_class, adt.attending_provider_npi, adt.icd10_code) == ("MRN1", "Alvarez", "Elena", dt.date(1958, 4, 12), "IMP", "ATT-77", "I21.9")


def test_split_messages(spark):
    text = ADT.replace("\r", "\n") + "\n\n" + ADT.replace("\r", "\r\n") + "\n"
    rows = split_messages(spark.createDataFrame([(text,), ("",)], "value string")).collect()
    assert [r.arrival_seq for r in rows] == [0, 1] and all(r.raw_message.startswith("MSH|") for r in rows)


def test_hl7_findings(spark):
    bad = [ADT.replace("19580412", d) for d in ("00000000", "19991399", "20001432", "99999999", "20191301", "1958-04")] + [ADT.replace("Alvarez^Elena^L", "^"), ADT.replace("|F\r", "|X\r"), ADT.replace("|WESTFAC|HUB", "||HUB"), "junk", ADT]
    parsed = hl7.parse_adt(hl7.parse_messages(spark.createDataFrame([(b,) for b in bad], "raw_message string")))
    got = {r.error_code: r.issue_count for r in dq.counts(dq.hl7_findings(parsed)).collect()}
    assert got == {"HL7_MALFORMED_DOB": 6, "HL7_MISSING_PID5": 1, "HL7_INVALID_GENDER": 1, "HL7_MISSING_MSH4": 1, "HL7_PARSE_FAILURE": 1}


BUNDLE = {
    "resourceType": "Bundle", "id": "b1", "type": "transaction", "meta": {"tag": [{"system": fhir.TENANT_TAG, "code": "T1"}, {"system": "urn:s", "code": "EHR"}]},
    "entry": [
        {"resource": {"resourceType": "Patient", "id": "p1", "name": [{"use": "nickname", "family": "N"}, {"use": "official", "family": "Alvarez", "given": ["Elena"]}], "birthDate": "1958-04-12", "gender": "female", "identifier": [{"type": {"coding": [{"code": "MR"}]}, "system": "urn:mrn", "value": "M1"}, {"type": {"coding": [{"code": "SS"}]}, "value": "123-45-6789"}]}},
        {"resource": {"resourceType": "Encounter", "id": "e1", "status": "finished", "class": {"code": "IMP"}, "subject": {"reference": "urn:uuid:p1"}, "period": {"start": "2024-03-15T08:00:00+05:00", "end": "2024-03-15T09:30:00Z"}}},
        {"resource": {"resourceType": "Observation", "id": "o1", "status": "final", "code": {"coding": [{"system": "http://loinc.org", "code": "4548-4"}], "text": "HbA1c"}, "subject": {"reference": "Patient/p1"}, "effectiveDateTime": "2024-03-15", "valueQuantity": {"value": 8.2, "unit": "%"}, "interpretation": [{"coding": [{"code": "H"}]}]}},
        {"resource": {"resourceType": "Observation", "id": "o2", "status": "final", "code": {"text": "mystery"}, "subject": {"reference": "Patient/p1"}, "valueQuantity": {"value": 42.0}}},
        {"resource": {"resourceType": "Condition", "id": "c1", "code": {"coding": [{"code": "E11.9"}]}, "subject": {"reference": "Patient/p1"}, "clinicalStatus": {"coding": [{"code": "active"}]}}},
        {"resource": {"resourceType": "Basic", "id": "x"}},
    ],
}


def test_fhir(spark):
    rows = split_bundles(spark.createDataFrame([(json.dumps([BUNDLE]),), ("{bad",), ('{"resourceType":"Patient","id":"q"}',)], "value string"))
    parsed = fhir.parse_bundles(rows)
    states = sorted((r.validation_status, r.tenant_id) for r in parsed.collect())
    assert states == [("ERROR", "UNKNOWN"), ("ERROR", "UNKNOWN"), ("PASS", "T1")]
    res = fhir.resources(parsed)
    assert res.filter("validation_status = 'PASS' and supported").count() == 5 and res.filter("validation_status = 'ERROR'").count() == 2
    assert fhir.skipped_types(res.filter("validation_status = 'PASS'")).first().skipped_types == ["Basic"]
    assert [r.entry_index for r in res.filter("bundle_payload is not null and validation_status = 'PASS'").collect()] == [0]
    p = fhir.patient_identities(res).first()
    assert (p.family_name, p.given_name, p.source_mrn, p.source_identifier_system, p.ssn_last4, p.birth_date) == ("Alvarez", "Elena", "M1", "urn:mrn", "6789", dt.date(1958, 4, 12))
    obs = {r.source_record_id: r for r in terminology.normalize_observations(fhir.observations(res)).collect()}
    assert (obs["o1"].loinc_code, obs["o1"].normalization_method, obs["o1"].value_quantity, obs["o1"].value_unit, obs["o1"].interpretation_code) == ("4548-4", "SOURCE_LOINC", 8.2, "%", "H")
    assert (obs["o2"].loinc_code, obs["o2"].normalization_method, obs["o2"].value_quantity) == (None, "UNMAPPED", 42.0)
    e = fhir.encounters(res).first()
    assert (e.period_start, e.length_of_stay_hours, e.subject_key) == (dt.datetime(2024, 3, 15, 8), 1.5, "p1")
    assert fhir.conditions(res).first().icd10_code == "E11.9"
    assert {r.error_code for r in dq.fhir_findings(parsed).collect()} == {"FHIR_PARSE_FAILURE"}


def test_terminology(spark):
    assert len(LOINC) == 28 and len(RXNORM) == 14 and len(SNOMED) == 10
    assert one(spark, " HbA1c ", terminology.loinc) == one(spark, "A1C", terminology.loinc) == "4548-4"
    assert one(spark, "nothing", terminology.loinc) is None
    assert one(spark, "I21.9", terminology.snomed) == "57054005"


@pytest.mark.parametrize(("codes", "score"), [("I21.9 E11.9 I10", 2), ("E11.9 E11.21", 2), ("Z00.00", 0), ("C50.9 C78.0", 8), ("K70.3 K72.1", 4), ("B20", 6), ("", None), *[(p.split()[0] + ".9" * ("." not in p.split()[0] and len(p.split()[0]) == 3), w) for n, (w, p) in CHARLSON.items() if n not in ("malignancy", "diabetes_complicated")]])
def test_charlson(spark, codes, score):
    df = spark.createDataFrame([("u", x) for x in codes.split()], "umpi string, icd10_code string")
    got = gold.charlson_index(df).first()
    assert (got.charlson_index if got else None) == score


@pytest.mark.parametrize(("gap", "hit"), [(dt.timedelta(days=19), True), (dt.timedelta(days=45), False), (dt.timedelta(0), False), (dt.timedelta(days=30), True), (dt.timedelta(days=30, seconds=1), False)])
def test_readmission(spark, gap, hit):
    t = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([("u", "A03", t), ("u", "A03", t - dt.timedelta(days=90)), ("u", "A01", t + gap)], "umpi string, event_type string, event_datetime timestamp")
    assert [r.is_readmission_30d for r in gold.readmissions(df).filter("event_type = 'A01'").collect()] == [hit]


def test_hba1c(spark):
    people = spark.createDataFrame([("a", "t", dt.date(1970, 1, 1), 1), ("b", "t", dt.date(1970, 1, 1), 2), ("c", "t", dt.date(2015, 1, 1), 3)], "umpi string, tenant_id string, birth_date date, arrival_seq int")
    dx = spark.createDataFrame([(u, "E11.9") for u in "abc"], "umpi string, icd10_code string")
    at = dt.datetime(2024, 3, 15)
    obs = spark.createDataFrame([("a", "4548-4", at, "final", 8.2, 2), ("a", "4548-4", at, "final", 7.0, 3), ("a", "4548-4", at - dt.timedelta(days=9), "final", 6.0, 1)], "umpi string, loinc_code string, effective_datetime timestamp, observation_status string, value_quantity double, arrival_seq int")
    got = {r.umpi: r for r in gold.hba1c_control(people, dx, obs, 2024).collect()}
    assert set(got) == {"a", "b"} and got["a"].in_numerator is False and got["a"].evidence_value == 8.2 and got["b"].in_numerator is None


@pytest.mark.parametrize("hot", [1_000_000, 7])
def test_identity_matches_a_sequential_run(spark, monkeypatch, hot):
    monkeypatch.setattr(identity, "HOT", hot)  # keys of more records are spread over tasks
    rng = random.Random(11)
    rows = [(i, rng.choice(["m1", "m2", "m3", "m4", ""]), rng.choice(["n1", None]), rng.choice(["s1", "s2", None]), rng.choice(["Doe", "Roe "]), rng.choice(["Al", "Bo"]), dt.date(1990, 1, rng.randrange(1, 4)), rng.choice(["1", "2", None]), rng.choice(["7", None])) for i in range(120)]
    df = spark.createDataFrame(rows, "arrival_seq int, source_mrn string, source_facility_npi string, source_identifier_system string, family_name string, given_name string, birth_date date, ssn_last4 string, postal_code string")
    index, expected = {}, {}
    for i, mrn, npi, system, family, given, born, ssn, zip_code in rows:
        family, given = family.strip().upper(), given.strip().upper()
        keys = [(1, mrn, npi) if mrn and npi else None, (2, system, mrn) if system and mrn else None, (3, ssn, born, family) if ssn else None, (4, born, family, given, zip_code) if zip_code else None]
        hit = next((k for k in keys if k and k in index), None)
        person = index[hit] if hit else i
        if not hit:
            index.update({k: i for k in keys if k})
        expected[i] = (person, identity.PASSES[keys.index(hit)][0] if hit else identity.NEW)
    got = {r.arrival_seq: r for r in identity.resolve(df).collect()}
    of = {r.umpi: i for i, r in got.items() if r.is_new_record}
    assert {i: (of[r.umpi], r.match_method) for i, r in got.items()} == expected
    assert len({p for p, _ in expected.values()}) > 5


def test_identity_chain_of_waiting_records(spark):
    # each record shares a number with the one before and a name with the one after: every second is new, one round a pair
    rows = [(i, f"m{i // 2}", "n", f"F{(i + 1) // 2}", "A", dt.date(1990, 1, 1), "7") for i in range(24)]
    df = spark.createDataFrame(rows, "arrival_seq int, source_mrn string, source_facility_npi string, family_name string, given_name string, birth_date date, postal_code string")
    got = {r.arrival_seq: r for r in identity.resolve(df).collect()}
    index, expected = {}, {}
    for i, mrn, _, family, *_ in rows:
        hit = next((k for k in (mrn, family) if k in index), None)
        expected[i] = index[hit] if hit else i
        if not hit:
            index.update({mrn: i, family: i})
    new = {r.umpi: i for i, r in got.items() if r.is_new_record}
    assert {i: new[r.umpi] for i, r in got.items()} == expected


def test_identity_seeds_and_chain(spark):
    schema = "arrival_seq int, source_mrn string, source_facility_npi string, source_identifier_system string"
    chain = spark.createDataFrame([(0, "k1", "n", "s2"), (1, "k1", "n", "s3"), (2, "k1", None, "s3"), (3, "old", "n", None)], schema)
    seeds = spark.createDataFrame([(0, "KNOWN", "old", "n")], "seq long, umpi string, source_mrn string, source_facility_npi string")
    got = {r.arrival_seq: r for r in identity.resolve(chain, seeds=seeds).collect()}
    assert got[1].umpi == got[0].umpi and got[2].is_new_record and got[2].umpi != got[0].umpi
    assert (got[3].umpi, got[3].match_method) == ("KNOWN", "MRN_NPI")


def test_csv_payload(spark):
    text = 'patient_id,first_name,last_name,dob\nPT1,"A ""x""","Line\nbreak",1990-01-02\r\n\nPT1,B,,02/03/1990\n'
    rows = csvbatch.payload_rows(spark.createDataFrame([("b", text)], "file_name string, raw_content string"), ("patient_id", "first_name", "last_name", "dob"))
    assert [(r.patient_id, r.first_name, r.last_name) for r in rows.orderBy("row_idx").collect()] == [("PT1", 'A "x"', "Line\nbreak"), ("PT1", "B", None)]


def test_governance(spark):
    df = spark.createDataFrame([("t1", 1), ("t2", 2), (None, 3)], "tenant_id string, x int")
    assert governance.tenant_view(df, "t1").count() == 1 and governance.tenant_view(df, None).count() == 0 and governance.tenant_view(df, None, True).count() == 3
    with pytest.raises(PermissionError):
        governance.operator_only(df, False)


def test_schemas():
    assert len(TABLES) == 22 and sum(map(len, LAYERS.values())) == 22 and len(TABLES["ingest_hl7_messages"]) == 10


def test_uscdi(spark):
    df = spark.createDataFrame([("u", "t", "", "Doe", None, "F", "OK", "7")], "umpi string, tenant_id string, given_name string, family_name string, birth_date date, gender string, state string, postal_code string")
    r = gold.uscdi_export(df).first()
    assert r.missing_elements == ["name.given", "birthDate"] and not r.qhin_ready and json.loads(r.uscdi_payload)["id"] == "u" and json.loads(r.uscdi_payload)["birthDate"] is None


def test_birth_date_key(spark):
    of = lambda i, more: {"resource": {"resourceType": "Patient", "id": i, **more}}
    bundle = {**BUNDLE, "entry": [of("there", {"birthDate": "1990-01-01"}), of("null", {"birthDate": None}), of("missing", {"name": [{"family": "X"}]}), {"resource": {"resourceType": "Basic"}}]}
    rows = split_bundles(spark.createDataFrame([(json.dumps(bundle),)], "value string"))
    got = [(r.error_code, r.source_record_id) for r in dq.fhir_findings(fhir.parse_bundles(rows)).collect()]
    assert got == [("FHIR_MISSING_BIRTH_DATE", "b1/missing")]
    assert [tuple(r) for r in dq.bundle_counts(fhir.parse_bundles(rows)).collect()] == [("T1", "transaction", "PASS", 1)]


def test_duplicates_are_of_one_file(spark):
    row = lambda f, i, p: (f, i, p, "A", "B", "1990-01-01", "7")
    df = spark.createDataFrame([row("a.csv", 1, "PT1"), row("b.csv", 1, "PT1"), row("b.csv", 2, "PT2"), row("b.csv", 3, " PT1"), row("b.csv", 4, ""), row("b.csv", 5, "")], "file_name string, row_idx long, patient_id string, first_name string, last_name string, dob string, zip string").withColumn("primary_dx_icd10", F.lit("I10"))
    twice = lambda found, code: [(r.file_name, r.source_record_id) for r in found.filter(F.col("error_code") == code).collect()]
    assert twice(dq.csv_bronze_findings(df, "patients"), "CSV_DUPLICATE_RECORD") == [("b.csv", "3: PT1")]
    assert twice(dq.csv_silver_findings(df), "CSV_DUPLICATE_ROW") == [("b.csv", "3: PT1")]


def test_csv_lab_bronze_findings(spark):
    df = spark.createDataFrame([("l.csv", 1, "R1", "P", "C", "POS"), ("l.csv", 2, "", "P", "C", "1.5"), ("l.csv", 3, "R3", "P", " ", "")], "file_name string, row_idx long, result_id string, patient_id string, test_code string, result_value string")
    got = sorted((r.source_record_id, r.error_code, r.field_path, r.error_severity) for r in dq.csv_bronze_findings(df, "labs").collect())
    assert got == [("1:R1", "CSV_NON_NUMERIC_RESULT", "result_value", "WARNING"), ("2:", "CSV_MISSING_REQUIRED_FIELD", "result_id", "ERROR"), ("3:R3", "CSV_MISSING_REQUIRED_FIELD", "result_value", "ERROR"), ("3:R3", "CSV_MISSING_REQUIRED_FIELD", "test_code", "ERROR")]


def test_one_decimal(spark):
    rng = random.Random(4)
    values = [8.35, 8.25, 8.75, 8.45, 7.95, 9.999, 0.05, 0.15, 6.0, 13.65, -8.35, *(round(rng.uniform(1, 20), 2) for _ in range(2000)), *(rng.uniform(0.1, 500) for _ in range(500))]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", one_decimal(F.col("v")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {i: round(v, 1) for i, v in enumerate(values)}


def test_observation_values_and_ranges(spark):
    lab = lambda i, **more: {"resource": {"resourceType": "Observation", "id": i, "status": "final", "subject": {"reference": "Patient/p1"}, **more}}
    two = {"coding": [{"system": "http://loinc.org", "code": "1-1", "display": "first"}, {"system": "urn:local", "code": "L", "display": "local"}, {"system": "http://loinc.org", "code": "2-2", "display": "second"}]}
    entry = [lab("text", code={"text": "x"}, valueString="POSITIVE"), lab("range", code=two, valueQuantity={"value": 5.25, "unit": "mg", "code": "mg/dL"}, referenceRange=[{"low": {"value": 4.0}, "high": {"value": 6.0, "unit": "mg"}}], interpretation=[{"coding": [{"code": "H", "display": "High"}]}], issued="2024-01-02T03:04:05Z")]
    rows = split_bundles(spark.createDataFrame([(json.dumps({**BUNDLE, "entry": entry}),)], "value string"))
    got = {r.source_record_id: r for r in fhir.observations(fhir.resources(fhir.parse_bundles(rows))).collect()}
    assert (got["text"].value_string, got["text"].value_quantity, got["text"].given_loinc) == ("POSITIVE", None, None)
    r = got["range"]
    assert (r.given_loinc, r.source_code, r.source_display, r.value_quantity, r.value_unit) == ("2-2", "L", "local", 5.25, "mg/dL")
    assert (r.reference_range_low, r.reference_range_high, r.reference_range_unit, r.interpretation_code, r.interpretation_display) == (4.0, 6.0, "mg", "H", "High")
    assert r.effective_datetime == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_person_ids_follow_the_record(spark):
    schema = "arrival_seq int, source_mrn string, source_facility_npi string, record_key string"
    one, two = (identity.resolve(spark.createDataFrame([(0, f"{r}-a", "n", f"{r}/a"), (1, f"{r}-b", "n", f"{r}/b"), (2, f"{r}-a", "n", f"{r}/c")], schema)).collect() for r in ("r1", "r2"))
    ids = lambda rows: {r.arrival_seq: r.umpi for r in rows}
    assert ids(one)[0] == ids(one)[2] and not set(ids(one).values()) & set(ids(two).values())
    again = identity.resolve(spark.createDataFrame([(5, "x", "n", "r1/a"), (9, "y", "n", "r1/b")], schema)).collect()
    assert {r.umpi for r in again} == set(ids(one).values())
