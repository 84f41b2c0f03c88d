"""Vendor CSV batches: stored payloads to rows, rows to patients, conditions and laboratory results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import blank_to_null, iso_date, stable_id, strip, to_float

# The columns of the two file types and those that must be filled.
PATIENT_COLUMNS = ("patient_id", "first_name", "last_name", "dob", "gender", "ssn_last4", "address", "city", "state", "zip", "phone", "pcp_npi", "insurance_id", "last_visit_date", "primary_dx_icd10")
LAB_COLUMNS = ("result_id", "patient_id", "collection_date", "test_code", "test_name", "result_value", "result_unit", "reference_range_low", "reference_range_high", "abnormal_flag", "ordering_provider_npi", "status")
REQUIRED = {"patients": ("patient_id", "last_name", "dob", "zip"), "labs": ("result_id", "patient_id", "test_code", "result_value")}
IDENTIFIER_SYSTEM = "urn:system:eclinicalworks"


def payload_rows(batches: DataFrame, columns: tuple[str, ...], payload: str = "raw_content") -> DataFrame:
    """The rows of stored CSV texts (header line first), with row_idx from 1. Line breaks within quotes belong to their field."""
    # breaks within quotes (odd parts of the text cut at quotes) are marked, so that the rest end lines
    text = F.regexp_replace(payload, r"\r\n?", "\n")
    marked = F.array_join(F.transform(F.split(text, '"'), lambda x, i: F.when(i % 2 == 1, F.translate(x, "\n", "\x1e")).otherwise(x)), '"')
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = batches.select(*(c for c in batches.columns if c != payload), F.posexplode(F.split(marked, "\n")).alias("row_idx", "_line")).filter("row_idx > 0 and trim(_line) <> ''")
    rows = rows.withColumn("_row", F.from_csv("_line", F.lit(schema), {"escape": '"'}))
    return rows.select(*(c for c in rows.columns if c not in ("_line", "_row")), *(F.translate(F.col("_row")[c], "\x1e", "\n").alias(c) for c in columns))


def csv_batches(rows: DataFrame, keys: list[str], errors: DataFrame) -> DataFrame:
    """Row count and status of every file: PASS unless a rule found something. errors: keys and one row for each finding."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("row_count"))
    bad = errors.groupBy(*keys).agg(F.count("*").alias("error_count"))
    return counts.join(bad, keys, "left").withColumn("error_count", F.coalesce("error_count", F.lit(0))).withColumn("validation_status", F.when(F.col("error_count") > 0, "ERROR").otherwise("PASS"))


def patients(rows: DataFrame) -> DataFrame:
    clean = {c: blank_to_null(strip(F.col(c))) for c in PATIENT_COLUMNS}
    return rows.select(
        *(c for c in rows.columns if c not in PATIENT_COLUMNS),
        clean["patient_id"].alias("source_record_id"), clean["patient_id"].alias("source_mrn"), clean["pcp_npi"].alias("source_facility_npi"), F.lit(IDENTIFIER_SYSTEM).alias("source_identifier_system"),
        clean["first_name"].alias("given_name"), clean["last_name"].alias("family_name"), iso_date(clean["dob"]).alias("birth_date"), clean["gender"].alias("gender"), clean["ssn_last4"].alias("ssn_last4"),
        clean["address"].alias("address_line"), clean["city"].alias("city"), clean["state"].alias("state"), clean["zip"].alias("postal_code"), clean["phone"].alias("phone"), clean["insurance_id"].alias("insurance_id"),
        iso_date(clean["last_visit_date"]).alias("last_visit_date"), clean["primary_dx_icd10"].alias("primary_dx_icd10"),
    )


def conditions(people: DataFrame) -> DataFrame:
    """The primary diagnosis of patient rows, as it is written."""
    return people.filter("primary_dx_icd10 is not null").withColumns({
        "condition_id": stable_id("source_record_id", "primary_dx_icd10"), "icd10_code": F.col("primary_dx_icd10"), "clinical_status": F.lit("active"), "verification_status": F.lit("confirmed"), "condition_category": F.lit("primary"),
    })


def labs(rows: DataFrame) -> DataFrame:
    """Laboratory rows before coding: a number if the value is one, else text; midnight of the collection date."""
    clean = {c: blank_to_null(strip(F.col(c))) for c in LAB_COLUMNS}
    number = to_float(clean["result_value"])
    return rows.select(
        *(c for c in rows.columns if c not in LAB_COLUMNS),
        clean["result_id"].alias("source_record_id"), clean["patient_id"].alias("patient_id"), clean["test_code"].alias("source_code"), clean["test_name"].alias("source_display"),
        number.alias("value_quantity"), F.when(number.isNull(), clean["result_value"]).alias("value_string"), clean["result_unit"].alias("value_unit"),
        to_float(clean["reference_range_low"]).alias("reference_range_low"), to_float(clean["reference_range_high"]).alias("reference_range_high"), clean["abnormal_flag"].alias("interpretation_code"),
        iso_date(clean["collection_date"]).cast("timestamp").alias("effective_datetime"), clean["status"].alias("observation_status"),
    )


def link_patients(results: DataFrame, people: DataFrame) -> DataFrame:
    """results with the umpi of their patient_id, UNKNOWN if there is none; of several links the last one counts."""
    known = people.groupBy(F.col("source_record_id").alias("patient_id")).agg(F.max_by("umpi", "row_idx").alias("_umpi"))
    return results.join(known, "patient_id", "left").withColumn("umpi", F.coalesce("_umpi", F.lit("UNKNOWN"))).drop("_umpi")
