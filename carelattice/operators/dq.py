"""Data-quality rules. Each finding is a row; nothing is dropped.

A rule table is evaluated in one pass: every row carries an array of its findings, which is then exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.codes import SEXES, SNOMED
from carelattice.functions.columns import hl7_timestamp, iso_date, lookup, not_blank, once, stable_id, strip, strip_column, to_float

from .csvbatch import REQUIRED
from .fhir import TENANT_TAG


_FOUND = "array<struct<tenant_id:string,source_record_id:string,f:struct<error_code:string,error_severity:string,error_message:string,field_path:string,raw_value:string>>>"
#: Characters of a raw CSV value that a finding shows.
LONGEST = 2000


def finding(when: Column, code: str, field: str, message: Column | str, raw: Column | None = None, severity: str = "ERROR", longest: int | None = None) -> Column:
    text = F.lit(None).cast("string") if raw is None else raw.cast("string") if longest is None else F.substr(raw.cast("string"), F.lit(1), F.lit(longest))
    row = F.struct(F.lit(code).alias("error_code"), F.lit(severity).alias("error_severity"), (F.lit(message) if isinstance(message, str) else message).alias("error_message"), F.lit(field).alias("field_path"), text.alias("raw_value"))
    return F.when(F.coalesce(when, F.lit(False)), row)


def found(rules: list[Column]) -> Column:
    """The array of a row's findings."""
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def _named(found: DataFrame, keep: list[str]) -> DataFrame:
    return found.select(stable_id("source_record_id", "f.error_code", "f.field_path").alias("error_id"), *keep, "source_record_id", "f.*")


def findings(rows: DataFrame, rules: list[Column] | str, record: Column | str, keep: list[str]) -> DataFrame:
    """One row for each finding: error_id, source_record_id, the kept columns and the finding's own. rules: or a column that holds what they found."""
    # outer, then without rows that have none: for an inner one Spark would apply the rules once more, to filter by their number
    out = rows.select(*keep, (F.col(record) if isinstance(record, str) else record).cast("string").alias("source_record_id"), F.explode_outer(F.col(rules) if isinstance(rules, str) else found(rules)).alias("f"))
    return _named(out.filter("f is not null"), keep)


def hl7_rules(raw: str = "raw_message", lenient: bool = False) -> list[Column]:
    """The rules on messages through parse_messages and parse_adt."""
    good = F.col("validation_status") != "ERROR"
    birth = F.coalesce(F.col("raw_birth_date"), F.lit(""))
    sex = strip(F.coalesce(F.col("raw_gender"), F.lit("")))
    name = F.translate(F.coalesce(F.col("raw_name"), F.lit("")), "^ ", "")
    return [
        finding(~good, "HL7_PARSE_FAILURE", "MSH", F.col("error"), F.col(raw), longest=500),
        finding(good & (F.coalesce("sending_facility", F.lit("")) == ""), "HL7_MISSING_MSH4", "MSH-4", "Sending facility is empty"),
        finding(good & F.col("has_pid") & (name == ""), "HL7_MISSING_PID5", "PID-5", "Patient name is empty", F.col("raw_name")),
        finding(good & F.col("has_pid") & (birth != "") & hl7_timestamp(birth, lenient).isNull(), "HL7_MALFORMED_DOB", "PID-7", "Birth date can't be read", birth),
        finding(good & F.col("has_pid") & (sex != "") & ~F.upper(sex).isin(*SEXES), "HL7_INVALID_GENDER", "PID-8", "Unknown administrative sex", sex),
    ]


def hl7_findings(parsed: DataFrame, record: str = "message_control_id", keep: tuple[str, ...] = ("tenant_id",), raw: str = "raw_message", lenient: bool = False) -> DataFrame:
    return findings(parsed, hl7_rules(raw, lenient), record, list(keep))


def fhir_findings(parsed: DataFrame, uri: str = TENANT_TAG, raw: str = "raw_bundle") -> DataFrame:
    """Bundles without a tenant tag, and one finding for each Patient without the birthDate key (a null birthDate is there)."""
    good = F.col("validation_status") == "PASS"
    tagged = F.exists(F.coalesce("bundle.meta.tag", F.array().cast("array<struct<system:string,code:string,display:string>>")), lambda t: F.coalesce(t["system"], F.lit("")) == uri)
    of_bundle = found([finding(~good, "FHIR_PARSE_FAILURE", "Bundle", F.col("error"), F.col(raw), longest=500), finding(good & ~tagged, "FHIR_MISSING_TENANT", "meta.tag", "No tenant tag")])
    # resources as maps, which tell a key that is null from one that isn't there; only of bundles where one could be missing
    entry = F.col("bundle.entry")
    unborn = lambda r: r["birthDate"].isNull() if "birthDate" in parsed.schema["bundle"].dataType["entry"].dataType.elementType["resource"].dataType.names else F.lit(True)
    doubt = F.coalesce(F.exists(entry, lambda e: e["resource"]["resourceType"].isNull() | (e["resource"]["resourceType"] == "Patient") & unborn(e["resource"])), F.lit(True))
    whole = F.when(good & doubt, F.from_json(F.col(raw), "struct<entry:array<struct<resource:map<string,string>>>>")["entry"]["resource"])
    missing = F.filter(whole, lambda r: (F.try_element_at(r, F.lit("resourceType")) == "Patient") & ~F.map_contains_key(r, F.lit("birthDate")))
    warning = finding(F.lit(True), "FHIR_MISSING_BIRTH_DATE", "Patient.birthDate", "Birth date is missing", severity="WARNING")
    record = lambda name, f: F.struct("tenant_id", name.cast("string").alias("source_record_id"), f.alias("f"))
    of_patients = F.transform(missing, lambda r: record(F.concat_ws("/", "bundle_id", F.try_element_at(r, F.lit("id"))), warning))
    both = F.concat(F.transform(of_bundle, lambda f: record(F.col("bundle_id"), f)), F.coalesce(of_patients, F.array().cast(_FOUND)))
    return _named(parsed.select(F.explode_outer(both).alias("x")).filter("x is not null").select("x.*"), ["tenant_id"])


def csv_bronze_findings(rows: DataFrame, kind: str, keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Findings on rows as they came. kind: patients or labs; rows have row_idx."""
    rules = [finding(~not_blank(F.col(c)), "CSV_MISSING_REQUIRED_FIELD", c, f"Required field {c} is empty") for c in REQUIRED[kind]]
    if kind == "labs":
        rules.append(finding(not_blank(F.col("result_value")) & to_float(F.col("result_value")).isNull(), "CSV_NON_NUMERIC_RESULT", "result_value", "Not a number", F.col("result_value"), "WARNING", LONGEST))
        return findings(rows, rules, _csv_record("result_id"), list(keep))
    dob = F.col("_dob")
    rules.append(finding((dob != "") & iso_date(dob).isNull(), "CSV_MALFORMED_DOB", "dob", "Expected YYYY-MM-DD", dob, longest=LONGEST))
    own = findings(once(rows, "_dob", strip_column(F.col("dob"))), rules, _csv_record("patient_id"), list(keep))
    return own.unionByName(_repeated_patients(rows, keep, "CSV_DUPLICATE_RECORD", longest=LONGEST))


def _csv_record(key: str) -> Column:
    return F.concat_ws(":", F.col("row_idx").cast("string"), F.coalesce(F.col(key), F.lit("")))


def _repeated_patients(rows: DataFrame, keep: tuple[str, ...], code: str, severity: str = "ERROR", longest: int | None = None) -> DataFrame:
    """Findings on rows whose patient came in an earlier row of their file. Only ids and places are joined; the other rules need no join, so long values stay where they are read."""
    narrow = with_first_row(rows.select(*dict.fromkeys([*keep, *_file_columns(rows), "row_idx", "patient_id"])), "patient_id")
    rule = finding(F.col("row_idx") > F.col("first_row_idx"), code, "patient_id", F.concat(F.lit("First seen in row "), F.col("first_row_idx").cast("string")), F.col("patient_id"), severity, longest)
    return findings(narrow, [rule], _csv_record("patient_id"), list(keep))


def _file_columns(rows: DataFrame) -> list[str]:
    return [c for c in ("batch_id", "file_name") if c in rows.columns]


def with_first_row(rows: DataFrame, key: str) -> DataFrame:
    """rows with first_row_idx, the first row of their file with the same key (their own without a key).

    Keys are counted before they are joined back, so blank and very frequent keys don't gather in one task.
    """
    text = F.coalesce(strip_column(F.col(key)), F.lit(""))
    of = [*_file_columns(rows), "_key"]
    first = rows.withColumn("_key", text).filter("_key <> ''").groupBy(*of).agg(F.min("row_idx").alias("first_row_idx"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return rows.withColumn("_key", text).join(first, of, "left").drop("_key").withColumn("first_row_idx", F.coalesce("first_row_idx", "row_idx"))


def csv_silver_findings(rows: DataFrame, keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Findings on patient rows on their way to the clinical tables."""
    dob, dx = F.col("_dob"), F.col("_dx")
    rules = [
        finding(~not_blank(F.col("first_name")), "CSV_BLANK_NAME", "first_name", "First name is blank", severity="WARNING"),
        finding(~not_blank(F.col("last_name")), "CSV_BLANK_NAME", "last_name", "Last name is blank", severity="WARNING"),
        finding((dob != "") & iso_date(dob).isNull(), "CSV_MALFORMED_DOB", "dob", "Expected YYYY-MM-DD", dob, "WARNING"),
        finding((dx != "") & lookup(dx, SNOMED).isNull(), "CSV_INVALID_ICD10", "primary_dx_icd10", "Diagnosis has no SNOMED code", dx, "WARNING"),
    ]
    clean = once(once(rows, "_dob", strip_column(F.col("dob"))), "_dx", strip_column(F.col("primary_dx_icd10")))
    own = findings(clean, rules, _csv_record("patient_id"), list(keep))
    return own.unionByName(_repeated_patients(rows, keep, "CSV_DUPLICATE_ROW", "WARNING"))


def csv_lab_findings(coded: DataFrame, keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Findings on coded laboratory rows: text values and codes without LOINC."""
    rules = [
        finding(F.col("value_string").isNotNull(), "CSV_TEXT_RESULT_VALUE", "result_value", "Text value", F.col("value_string"), "WARNING"),
        finding(F.col("loinc_code").isNull(), "CSV_UNMAPPED_LAB_CODE", "test_code", "Neither code nor name has a LOINC code", F.coalesce("source_code", "source_display"), "WARNING"),
    ]
    return findings(coded, rules, "source_record_id", list(keep))


def counts(found: DataFrame, *by: str) -> DataFrame:
    return found.groupBy(*(by or ("error_code", "field_path"))).agg(F.count("*").alias("issue_count"))


def audit_log(rows: DataFrame, by: list[str], failed: Column, at: str | None = None) -> DataFrame:
    """Record, pass and error counts (and first and last time) of every source."""
    extra = [F.min(at).alias("started_at"), F.max(at).alias("completed_at")] if at else []
    return rows.groupBy(*by).agg(F.count("*").alias("record_count"), F.count_if(~failed).alias("pass_count"), F.count_if(failed).alias("error_count"), *extra)


def csv_audit(batches: DataFrame, found: DataFrame) -> DataFrame:
    """Counts of every CSV file: errors are its empty required fields, so a row with two of them counts twice."""
    empty = found.filter("error_code = 'CSV_MISSING_REQUIRED_FIELD'").groupBy("file_name").agg(F.count("*").alias("error_count"))
    rows = batches.select("file_name", F.col("row_count").alias("record_count")).join(empty, "file_name", "left").withColumn("error_count", F.coalesce("error_count", F.lit(0)))
    return rows.select(F.col("file_name").alias("source_name"), "record_count", (F.col("record_count") - F.col("error_count")).alias("pass_count"), "error_count")


def bundle_counts(parsed: DataFrame) -> DataFrame:
    """Bundles by tenant, type and status."""
    return parsed.groupBy("tenant_id", "bundle_type", "validation_status").agg(F.count("*").alias("bundles"))


def profile(rows: DataFrame, exact: bool = True) -> DataFrame:
    """Of each column: row_count, nulls, blanks, distinct_values, repeated_rows (whose value isn't alone) and most (of its commonest value).

    Columns are unpivoted, so all are counted by one aggregation by (column, value), which combines before it is shuffled,
    and one by column. exact=False: a single aggregation with a HyperLogLog sketch for each column, for tables with too
    many values to shuffle; repeated_rows and most are null then.
    """
    text = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
    blank = lambda v: F.trim(v) == ""
    if not exact:
        parts = [F.struct(F.lit(c).alias("column_name"), F.count("*").alias("row_count"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_if(blank(F.col(c))).alias("blanks"), F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(c)), F.lit(0)).alias("distinct_values"), F.lit(None).cast("long").alias("repeated_rows"), F.lit(None).cast("long").alias("most")).alias(c) for c in rows.columns]
        return text.agg(*parts).select(F.explode(F.array(*rows.columns)).alias("p")).select("p.*")
    pairs = text.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in rows.columns))).alias("p")).select("p.*")
    values = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    some = F.col("value").isNotNull()
    return values.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(~some, F.col("n"))), F.lit(0)).alias("nulls"), F.coalesce(F.sum(F.when(blank(F.col("value")), F.col("n"))), F.lit(0)).alias("blanks"), F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(some & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("repeated_rows"), F.max(F.when(some, F.col("n"))).alias("most"),
    )


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """The keys that more than one row has, and how many have them."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
