"""Queries over files and stored state: the fixture views are written to the shared folder as source files or tables of
earlier runs, and read back by the sources; table profiles; persons by run order; each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions.codes import CHRONIC
from carelattice.operators import csvbatch, dq, fhir, gold, hl7, identity
from carelattice.operators.shared import checkpoint, shared_folder
from carelattice.sources.files import csv_rows, fhir_files, hl7_files, table_rows
from carelattice.sources.writers import append, clone_tables, create_tables, replace_run, truncate, write_json_array

from . import fixtures as fx

#: Bundle files that fhir_arrays writes.
FILES = 8
#: Stands in one element of every bundle file, which is no JSON.
BROKEN = '{"resourceType":"Bundle","id":}'


def _folder(s: SparkSession) -> str:
    return shared_folder(s, f"sources-{uuid.uuid4()}")


def hl7_files_read(s: SparkSession, d: str) -> DataFrame:
    """Messages by line, the segments of each on lines of their own, read from files in blocks."""
    path = _folder(s)
    fx.hl7_raw(s, d).select(F.replace("raw_message", F.lit("\r"), F.lit("\n"))).write.text(path)
    rows = hl7.parse_adt(hl7.parse_messages(hl7_files(s, path)))
    return rows.select("message_control_id", "tenant_id", "mrn", "validation_status", F.size(F.split("raw_message", "\n")).alias("segments"))


def fhir_arrays(s: SparkSession, d: str) -> DataFrame:
    """Bundles in a few files, each one JSON array, with an element that is no JSON and one that is a number."""
    path, n = _folder(s), F.lit(1 << 40)
    rows = fx.fhir_parts(s, d).withColumns({"file": F.col("o_orderkey") % FILES, "at": F.col("o_orderkey")})
    ends = s.range(FILES).select(F.col("id").alias("file"), F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("at"), F.lit(f"[ {BROKEN},").alias("value")), F.struct(n.alias("at"), F.lit("17]").alias("value")))).alias("x"))
    ordered = rows.unionByName(ends.select("file", "x.*"), allowMissingColumns=True).repartitionById(FILES, F.col("file").cast("int")).sortWithinPartitions("file", "at")  # a task for each file
    # texts are made where they are written: neither shuffled nor sorted
    ordered.select("file", F.coalesce("value", F.concat(fx.bundle_text(), F.lit(","))).alias("value")).write.partitionBy("file").text(path)
    parsed = fhir.parse_bundles(fhir_files(s, path), kinds=())  # no resource is taken in, types are common fields
    return parsed.select(F.when(F.col("validation_status") == "PASS", F.col("bundle_id")).alias("bundle_id"), "validation_status", "tenant_id", F.array_join("resource_types", ",").alias("resource_types"), F.when(F.col("validation_status") == "ERROR", F.col("raw_bundle")).alias("raw"))


def csv_files_read(s: SparkSession, d: str) -> DataFrame:
    """Patient rows with quoted commas, quotes and line breaks, read from files in blocks."""
    path = _folder(s)
    c = F.col("c_custkey")
    text = F.concat(c.cast("string"), F.when(c % 3 == 0, F.lit(' "Rear",\nDoor')).when(c % 3 == 1, F.lit(", Apt 1")).otherwise(F.lit("")))
    rows = fx.base(s, d, "customer").select(F.concat(F.lit("PT"), c.cast("string")).alias("patient_id"), text.alias("address"), F.lit("Tulsa").alias("city"))
    rows.write.option("header", True).option("escape", '"').option("lineSep", "\n").csv(path)
    return csv_rows(s, path).select("patient_id", "address", "city", (F.col("row_idx") > 0).alias("numbered"))


def json_array(s: SparkSession, d: str) -> DataFrame:
    """Patients written as one JSON array over several parts, read back as text: each record's place and fields."""
    path = _folder(s)
    write_json_array(fx.patients(s, d).select("arrival_seq", "umpi", "ssn_last4"), path, ["arrival_seq"])
    lines = s.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    record = F.from_json(F.regexp_extract("value", r"^[\[,]?(.*)$", 1), "arrival_seq long, umpi string, ssn_last4 string")
    return lines.select(F.substr("value", F.lit(1), F.lit(1)).alias("mark"), record.alias("r")).select("mark", "r.arrival_seq", "r.umpi", "r.ssn_last4")


def _records(s: SparkSession, d: str) -> DataFrame:
    """Three records for each customer, one a run: by what the second is known again follows from the key modulo 4."""
    c = F.col("c_custkey")
    people = fx.spread(fx.base(s, d, "customer").select(c), "c_custkey").select(c, c.cast("string").alias("x"), F.date_add(F.lit(fx.AS_OF), (-c % 20000).cast("int")).alias("birth_date"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))).alias("run"))
    i, again = c % 4, F.col("run") == 2
    own = lambda prefix: F.concat(F.lit(prefix), F.col("x"))
    return people.select(
        "run", (c + F.col("run") * 1_000_000_000).alias("arrival_seq"), F.concat(F.lit("r"), F.col("run").cast("string"), F.lit("/"), F.col("x")).alias("record_key"), F.concat_ws("-", own("S"), "run").alias("source_id"),
        F.when(again & (i != 0), own("Q")).otherwise(own("M")).alias("source_mrn"), F.when((F.col("run") == 3) & (i == 3), "N3").otherwise("N1").alias("source_facility_npi"), F.lit("S1").alias("source_identifier_system"), F.lit("1234").alias("ssn_last4"),
        F.when(again & (i == 2), own("Else")).otherwise(own("Fam")).alias("family_name"), F.lit("Ann").alias("given_name"), F.when(again & (i == 3), "70009").otherwise("70001").alias("postal_code"), "birth_date",
    )


def mpi_runs(s: SparkSession, d: str) -> DataFrame:
    """Runs r1, r2, r3, then r1 and r2 replayed in the presence of all: what the replays find, and the index as of r2."""
    records = _records(s, d)
    runs = s.createDataFrame([("r1", 1), ("r2", 2), ("r3", 3)], "run_id string, run_seq int")
    people = links = None
    resolved: dict[str, DataFrame] = {}

    def resolve(n: int) -> DataFrame:
        seeds = None if people is None else identity.seeds_before(people, links, runs, n)
        return identity.resolve(records.filter(F.col("run") == n), seeds=seeds)

    for n in (1, 2, 3):
        got = resolve(n)
        path = _folder(s)
        got.withColumns({"pipeline_run_id": F.lit(f"r{n}"), "place": F.lpad(F.col("arrival_seq").cast("string"), 20, "0")}).write.parquet(path)
        resolved[f"r{n}"] = s.read.parquet(path)
        people = links = resolved["r1"] if n == 1 else links.unionByName(resolved[f"r{n}"])
    again = resolve(1).withColumn("step", F.lit("r1 again")).unionByName(resolve(2).withColumn("step", F.lit("r2 again")))
    shown = again.unionByName(resolved["r3"].drop("pipeline_run_id", "place").withColumn("step", F.lit("r3")))
    minted = links.filter("is_new_record").select("pipeline_run_id", "umpi")
    index = identity.person_index(minted, links.select("pipeline_run_id", "umpi"), runs, 2).groupBy(F.col("valid_from").alias("valid"), "linked_record_count").agg(F.count("*").alias("n"))
    of_index = index.select(F.lit("index").alias("step"), F.lit(None).cast("string").alias("match_method"), F.col("valid").cast("int").alias("first"), F.col("linked_record_count").alias("records"), "n")
    return shown.groupBy("step", "match_method").agg(F.count("*").alias("n")).select("step", "match_method", F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("records"), "n").unionByName(of_index)


def mpi_shared_number(s: SparkSession, d: str) -> DataFrame:
    """A default record number that a third of all records share; names that two records have in common."""
    c = F.col("o_orderkey")
    number = F.when(c % 3 == 0, F.lit("0000")).otherwise(F.concat(F.lit("M"), c.cast("string")))
    rows = fx.base(s, d, "orders").select(
        c.alias("arrival_seq"), number.alias("source_mrn"), F.lit("N1").alias("source_facility_npi"), F.concat(F.lit("F"), F.floor((c + 1) / 2).cast("string")).alias("family_name"),
        F.lit("Ann").alias("given_name"), F.lit(fx.AS_OF).alias("birth_date"), F.lit("7").alias("postal_code"),
    )
    return identity.resolve(rows).groupBy("match_method").agg(F.count("*").alias("records"), F.countDistinct("umpi").alias("persons"))


def table_profile(s: SparkSession, d: str) -> DataFrame:
    return dq.profile(fx.csv_raw(s, d).select("patient_id", "first_name", "last_name", "zip", "phone", "primary_dx_icd10", F.when(F.col("ssn_last4") > "5000", F.col("ssn_last4")).alias("ssn_last4")))


def repeated_keys(s: SparkSession, d: str) -> DataFrame:
    return dq.repeated_keys(fx.csv_raw(s, d), ["patient_id", "dob"])


def stored_summaries(s: SparkSession, d: str) -> DataFrame:
    """Summaries stored in a table by run, one run replaced, one emptied and one appended to; read by run, then all of a clone and of what is truncated."""
    db, kind = f"stored_{uuid.uuid4().hex}", "analytics_patient_summary"
    for name in (db, f"{db}_copy"):
        s.sql(f"CREATE DATABASE {name} LOCATION '{_folder(s)}'")
    create_tables(s, db, [kind])
    create_tables(s, db, [kind])
    clone_tables(s, db, f"{db}_copy")
    stored, copy = f"{db}.{kind}", f"{db}_copy.{kind}"
    rows = checkpoint(gold.summary_table(gold.patient_summary(fx.patients(s, d), fx.encounters(s, d), fx.diagnoses(s, d), fx.AS_OF)))  # worked out once for all that is stored
    chosen = {"first": rows.filter("risk_tier <> 'LOW'"), "second": rows.filter("charlson_index = 0"), "third": rows}
    for run, own in (("first", rows), ("second", chosen["second"]), ("third", rows), ("first", chosen["first"]), ("third", rows.limit(0))):
        replace_run(own, stored, run)
    append(chosen["first"].filter("ed_visit_count > 0").withColumn("pipeline_run_id", F.lit("third")), stored)
    append(rows.limit(0), stored)
    append(s.table(stored), copy)
    truncate(s, [copy], "prod")  # only empties tables in dev
    flags = F.transform(F.sort_array(F.map_keys("chronic_condition_flags")), lambda k: F.concat(k, F.lit("="), F.try_element_at("chronic_condition_flags", k).cast("string")))
    read = [table_rows(s, stored, run).withColumn("source", F.lit("by run")) for run in chosen] + [table_rows(s, copy).withColumn("source", F.lit("copy"))]
    shown = read[0].unionByName(read[1]).unionByName(read[2]).unionByName(read[3])
    counts = ("total_encounter_count", "ed_visit_count", "inpatient_days")
    return shown.select("source", F.col("pipeline_run_id").alias("run"), "patient_hash", "tenant_id", "charlson_index", "risk_tier", F.array_join(flags, ",").alias("flags"), *(F.col(c).cast("long").alias(c) for c in counts), F.date_format("last_encounter_date", "yyyy-MM-dd").alias("last_encounter_date"))


def finding_messages(s: SparkSession, d: str) -> DataFrame:
    """What findings on patient rows say."""
    return dq.csv_bronze_findings(fx.csv_raw(s, d), "patients").groupBy("error_code", "field_path", "error_message").agg(F.count("*").alias("n"))


_ALL = (stored_summaries, finding_messages, hl7_files_read, fhir_arrays, csv_files_read, json_array, mpi_runs, mpi_shared_number, table_profile, repeated_keys)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def sql(msgs: str, csvp: str, summary: str, hl7_tenant: str, fhir_tenant: str) -> dict[str, str]:
    """msgs, csvp, summary: the WITH clauses of the message and patient rows and of the summaries; the tenants: expressions over msgs."""
    columns = ("patient_id", "first_name", "last_name", "zip", "phone", "primary_dx_icd10", "ssn_last4")
    profile = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, count(*) FILTER (trim({c}) = '') AS blanks, count(DISTINCT {c}) AS distinct_values, (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)) AS repeated_rows, (SELECT max(n) FROM (SELECT count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c})) AS most FROM t"
        for c in columns
    )
    dob = "CASE WHEN c % 20 = 5 THEN strftime(born, '%m/%d/%Y') ELSE strftime(born, '%Y-%m-%d') END"
    flags = " || ',' || ".join(f"'{n}=' || has_{n.lower()}::VARCHAR" for n in sorted(CHRONIC))
    return {
        "stored_summaries": summary + f"""SELECT source, run, patient_hash, tenant_id, charlson_index, risk_tier, {flags} AS flags, encounters_12m::BIGINT AS total_encounter_count, ed_visits_12m::BIGINT AS ed_visit_count, inpatient_days_12m::BIGINT AS inpatient_days, last_encounter_date
            FROM summary, (VALUES ('first'), ('second'), ('third')) r(run), (VALUES ('by run'), ('copy')) v(source) WHERE CASE run WHEN 'second' THEN charlson_index = 0 ELSE risk_tier <> 'LOW' AND (run = 'first' OR ed_visits_12m > 0) END""",
        "finding_messages": csvp + """SELECT error_code, field_path, error_message, count(*) AS n FROM (
            SELECT 'CSV_MISSING_REQUIRED_FIELD' AS error_code, 'last_name' AS field_path, 'Required field last_name is empty' AS error_message FROM csvp WHERE c % 25 = 4
            UNION ALL SELECT 'CSV_MISSING_REQUIRED_FIELD', 'zip', 'Required field zip is empty' FROM csvp WHERE c % 60 = 8
            UNION ALL SELECT 'CSV_MALFORMED_DOB', 'dob', 'Expected YYYY-MM-DD' FROM csvp WHERE c % 20 = 5
            UNION ALL SELECT 'CSV_DUPLICATE_RECORD', 'patient_id', 'First seen in row ' || min(row_idx) FROM csvp GROUP BY c HAVING count(*) > 1) GROUP BY ALL""",
        "hl7_files_read": msgs + f"SELECT 'MSG' || k AS message_control_id, {hl7_tenant} AS tenant_id, 'MRN' || c AS mrn, 'PASS' AS validation_status, 4 + (k % 2 = 0)::INT + (k % 7 <> 0)::INT + (k % 11 = 0)::INT AS segments FROM msgs",
        "fhir_arrays": msgs + f"""SELECT 'B' || k AS bundle_id, 'PASS' AS validation_status, {fhir_tenant} AS tenant_id, CASE WHEN k % 13 = 0 THEN 'Basic,' ELSE '' END || CASE WHEN k IN (SELECT l_orderkey FROM lineitem) THEN 'Condition,Encounter,Observation,Patient' ELSE 'Encounter,Patient' END AS resource_types, NULL AS raw FROM msgs
            UNION ALL SELECT NULL, 'ERROR', 'UNKNOWN', '', raw FROM range({FILES}), (VALUES ('{BROKEN}'), ('17')) v(raw)""",
        "csv_files_read": "SELECT 'PT' || c_custkey AS patient_id, c_custkey || CASE c_custkey % 3 WHEN 0 THEN ' \"Rear\",' || chr(10) || 'Door' WHEN 1 THEN ', Apt 1' ELSE '' END AS address, 'Tulsa' AS city, true AS numbered FROM customer",
        "json_array": "SELECT CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer) THEN '[' ELSE ',' END AS mark, c_custkey AS arrival_seq, 'P' || lpad(c_custkey::VARCHAR, 9, '0') AS umpi, CASE WHEN c_custkey % 5 <> 0 THEN lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS ssn_last4 FROM customer UNION ALL SELECT ']', NULL, NULL, NULL",
        # a later run knows record numbers and, of patients, names with birth date and postal code, but neither identifiers nor social security numbers
        "mpi_runs": """WITH r AS (SELECT c_custkey % 4 AS i, count(*) AS n FROM customer GROUP BY 1),
            found AS (SELECT 'r1 again' AS step, 'NEW_RECORD' AS match_method, n FROM r
              UNION ALL SELECT 'r2 again', CASE i WHEN 0 THEN 'MRN_NPI' WHEN 1 THEN 'DOB_NAME_ZIP' ELSE 'NEW_RECORD' END, n FROM r
              UNION ALL SELECT 'r3', CASE i WHEN 3 THEN 'DOB_NAME_ZIP' ELSE 'MRN_NPI' END, n FROM r)
            SELECT step, match_method, NULL::INT AS first, NULL::INT AS records, sum(n)::BIGINT AS n FROM found GROUP BY ALL
            UNION ALL SELECT 'index', NULL, first, records, sum(n)::BIGINT FROM (SELECT 1 AS first, CASE WHEN i < 2 THEN 2 ELSE 1 END AS records, n FROM r UNION ALL SELECT 2, 1, n FROM r WHERE i >= 2) GROUP BY ALL""",
        # the shared number belongs to the first record with it that its neighbour's name doesn't match; who is matched lends no name
        "mpi_shared_number": """WITH o AS (SELECT o_orderkey AS k, o_orderkey - 1 IN (SELECT o_orderkey FROM orders) AS prev FROM orders), owner AS (SELECT min(k) AS n FROM o WHERE k % 3 = 0 AND (k % 2 = 1 OR NOT prev)),
            found AS (SELECT k, n, CASE WHEN k % 3 = 0 THEN CASE WHEN k = n THEN 'NEW_RECORD' WHEN k > n THEN 'MRN_NPI' ELSE 'DOB_NAME_ZIP' END WHEN k % 2 = 0 AND prev AND ((k - 1) % 3 <> 0 OR k - 1 = n) THEN 'DOB_NAME_ZIP' ELSE 'NEW_RECORD' END AS match_method FROM o, owner)
            SELECT match_method, count(*) AS records, count(DISTINCT CASE match_method WHEN 'NEW_RECORD' THEN k WHEN 'MRN_NPI' THEN n ELSE k - 1 END) AS persons FROM found GROUP BY 1""",
        "table_profile": csvp + f""", t AS (SELECT 'PT' || c AS patient_id, CASE WHEN c % 25 = 3 THEN ' ' ELSE 'G' || (c % 53) END AS first_name, CASE WHEN c % 25 = 4 THEN '' ELSE 'F' || (c % 97) END AS last_name, CASE WHEN c % 60 = 8 THEN '' ELSE (70000 + c % 500)::VARCHAR END AS zip, '' AS phone, dx AS primary_dx_icd10, CASE WHEN c % 10000 > 5000 THEN lpad((c % 10000)::VARCHAR, 4, '0') END AS ssn_last4 FROM csvp) {profile}""",
        "repeated_keys": csvp + f"SELECT 'PT' || c AS patient_id, {dob} AS dob, count(*) AS n FROM csvp GROUP BY ALL HAVING count(*) > 1",
    }
