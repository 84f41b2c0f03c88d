"""HL7 v2 messages to columns, by native string and array expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.codes import PATIENT_CLASS
from carelattice.functions.columns import blank_to_null, first_filled, hl7_date, hl7_datetime, hl7_timestamp, lookup, once, part, stable_id, strip, strip_column


def _lines(raw: Column) -> Column:
    """Lines split at CR if there is any, else at line feeds."""
    return F.when(F.instr(raw, "\r") > 0, F.split(raw, "\r")).otherwise(F.split(raw, "\n"))


def _line(lines: Column, segment: str) -> Column:
    return F.get(F.filter(lines, lambda x: x.startswith(segment)), F.lit(0))


def _split(line: Column, separator: Column) -> Column:
    # the usual separator is split at without compiling a pattern for each line
    return F.when(separator == "|", F.split(line, r"\|")).otherwise(F.split(line, F.concat(F.lit(r"\Q"), separator, F.lit(r"\E"))))


def msh_fields(raw: Column) -> Column:
    """Struct of the MSH fields; all null without an MSH line. The fourth character separates."""
    line = _line(_lines(raw), "MSH")
    return _header(F.substr(line, F.lit(4), F.lit(1)), _msh_split(line))


def _msh_split(line: Column) -> Column:
    separator = F.substr(line, F.lit(4), F.lit(1))
    return F.when(separator != "", _split(line, separator))


def _header(separator: Column, fields: Column) -> Column:
    at = lambda i: blank_to_null(F.get(fields, F.lit(i)))
    named = {"sending_application": 2, "sending_facility": 3, "receiving_application": 4, "receiving_facility": 5, "message_time": 6, "message_type": 8, "control_id": 9, "version": 11}
    return F.struct(blank_to_null(separator).alias("separator"), *(at(i).alias(n) for n, i in named.items()), F.get(fields, F.lit(3)).alias("raw_facility"))


def ztn_pairs(raw: Column, separator: Column) -> Column:
    """Array of the first ZTN line's (key, value) fields; null without one."""
    fields = _split(_line(_lines(raw), "ZTN"), separator)
    cut = F.transform(F.filter(fields, lambda x: F.instr(x, "=") > 0), lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.substr(x, F.instr(x, F.lit("=")) + 1).alias("value")))
    return F.transform(cut, lambda p: F.struct(strip_column(p["key"]).alias("key"), strip_column(p["value"]).alias("value")))


def with_ztn(rows: DataFrame, raw: Column, separator: Column) -> DataFrame:
    """rows with ztn, their ztn_pairs."""
    return once(rows, "ztn", ztn_pairs(raw, separator))


def ztn_value(key: str) -> Column:
    """The value of a key of with_ztn's rows, the last of equal keys."""
    return F.try_element_at(F.filter("ztn", lambda p: p["key"] == key), F.lit(-1))["value"]


def feed_type(message_type: Column) -> Column:
    return F.when(F.coalesce(message_type, F.lit("")) != "", strip(F.substring_index(message_type, "^", 1)))


def parse_messages(messages: DataFrame, default_tenant: str | None = None, raw: str = "raw_message", lenient: bool = False) -> DataFrame:
    """messages with the parsed header. What can't be parsed stays, with validation_status ERROR and its error.

    Tenant: the ZTN segment, else default_tenant, else the sending facility, else UNKNOWN; empty values don't count.
    """
    df = once(messages, "_msh_line", _line(_lines(F.col(raw)), "MSH"))
    df = once(df, "_msh", _msh_split(F.col("_msh_line")))
    df = df.withColumn("msh", _header(F.substr("_msh_line", F.lit(4), F.lit(1)), F.col("_msh")))
    df, ztn = with_ztn(df, F.col(raw), F.coalesce("msh.separator", F.lit("|"))), ztn_value
    bad = F.col("msh.separator").isNull()
    default = F.lit(default_tenant or None).cast("string")
    return df.select(
        *messages.columns,
        F.when(bad, first_filled(default, F.lit("UNKNOWN"))).otherwise(first_filled(ztn("TENANT_ID"), default, F.col("msh.sending_facility"), F.lit("UNKNOWN"))).alias("tenant_id"),
        first_filled(ztn("SOURCE_SYSTEM"), F.col("msh.sending_application")).alias("source_system"),
        first_filled(ztn("FEED_TYPE"), feed_type(F.col("msh.message_type"))).alias("feed_type"),
        ztn("BATCH_ID").alias("batch_id"),
        F.col("msh.sending_application").alias("sending_application"),
        F.col("msh.raw_facility").alias("sending_facility"),
        F.col("msh.receiving_application").alias("receiving_application"),
        F.col("msh.receiving_facility").alias("receiving_facility"),
        F.col("msh.message_type").alias("full_message_type"),
        blank_to_null(part(F.col("msh.message_type"), "^", 0)).alias("message_type"),
        blank_to_null(part(F.col("msh.message_type"), "^", 1)).alias("message_event"),
        F.col("msh.control_id").alias("message_control_id"),
        F.col("msh.version").alias("hl7_version"),
        hl7_timestamp(F.col("msh.message_time"), lenient).alias("message_datetime"),
        F.length(F.col(raw)).alias("raw_length"),
        F.when(bad, "ERROR").otherwise("PASS").alias("validation_status"),
        F.when(bad, "No MSH segment found").alias("error"),
    )


def segments(raw: Column) -> Column:
    """Array of segments, each split at `|`; any line ends, lines trimmed."""
    text = F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.transform(F.split(text, "\n"), strip_column)
    return F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.split(x, r"\|"))


def segment(of: Column, name: str) -> Column:
    """The last segment of this name (null if none)."""
    return F.try_element_at(F.filter(of, lambda s: F.get(s, F.lit(0)) == name), F.lit(-1))


def _field(seg: Column, i: int) -> Column:
    return F.get(seg, F.lit(i))


def parse_adt(messages: DataFrame, raw: str = "raw_message") -> DataFrame:
    """messages with the patient, visit and diagnosis fields of ADT messages."""
    df = messages.withColumn("_s", segments(F.col(raw)))
    pid, evn, pv1, dg1 = (F.col(f"_{n}") for n in ("pid", "evn", "pv1", "dg1"))
    df = df.withColumns({"_pid": segment(F.col("_s"), "PID"), "_evn": segment(F.col("_s"), "EVN"), "_pv1": segment(F.col("_s"), "PV1"), "_dg1": segment(F.col("_s"), "DG1")})
    facility = blank_to_null(part(_field(pid, 3), "^", 3))
    return df.select(
        *messages.columns,
        blank_to_null(part(_field(pid, 3), "^", 0)).alias("mrn"),
        facility.alias("mrn_facility"),
        blank_to_null(part(_field(pid, 5), "^", 0)).alias("family_name"),
        blank_to_null(part(_field(pid, 5), "^", 1)).alias("given_name"),
        hl7_date(_field(pid, 7)).alias("birth_date"),
        blank_to_null(_field(pid, 8)).alias("gender"),
        hl7_datetime(_field(evn, 2)).alias("event_datetime"),
        lookup(_field(pv1, 2), PATIENT_CLASS).alias("encounter_class"),
        first_filled(part(_field(pv1, 3), "^", 3), facility).alias("facility"),
        blank_to_null(F.replace(part(_field(pv1, 7), "^", 0), F.lit("NPI-"), F.lit(""))).alias("attending_provider_npi"),
        blank_to_null(part(_field(pv1, 7), "^", 1)).alias("attending_provider_name"),
        blank_to_null(part(_field(dg1, 3), "^", 0)).alias("icd10_code"),
        blank_to_null(part(_field(dg1, 3), "^", 1)).alias("icd10_display"),
        pid.isNotNull().alias("has_pid"),
        _field(pid, 5).alias("raw_name"),
        _field(pid, 7).alias("raw_birth_date"),
        _field(pid, 8).alias("raw_gender"),
    )


def admissions(parsed: DataFrame) -> DataFrame:
    """The ADT A01 and A03 messages that were not rejected."""
    # a row number that the filter reads keeps it above the parse; pushed below, it would parse every message once more
    rows = parsed.withColumn("_row", F.monotonically_increasing_id())
    return rows.filter((F.col("_row") >= 0) & (F.col("message_type") == "ADT") & F.col("message_event").isin("A01", "A03") & (F.col("validation_status") != "ERROR")).drop("_row")


def adt_encounters(adt: DataFrame) -> DataFrame:
    """An encounter row for each A01 (in progress, admit) and A03 (finished, discharge); the stay's length isn't known."""
    a01 = F.col("message_event") == "A01"
    return adt.withColumns({
        "encounter_id": stable_id("message_control_id", "message_event", "event_datetime"),
        "encounter_status": F.when(a01, "in-progress").otherwise("finished"),
        "period_start": F.when(a01, F.col("event_datetime")),
        "period_end": F.when(~a01, F.col("event_datetime")),
        "length_of_stay_hours": F.lit(None).cast("double"),
    })


def adt_conditions(adt: DataFrame) -> DataFrame:
    """A condition row for each message with a diagnosis: active on admission, resolved on discharge."""
    a01 = F.col("message_event") == "A01"
    return adt.filter(F.col("icd10_code").isNotNull()).withColumns({
        "condition_id": stable_id("message_control_id", "icd10_code"),
        "clinical_status": F.when(a01, "active").otherwise("resolved"),
        "condition_category": F.lit("primary"),
        "onset_datetime": F.when(a01, F.col("event_datetime")),
    })


def oru_observations(messages: DataFrame, raw: str = "raw_message") -> DataFrame:
    """Extension: the OBX segments of messages as observations, one row each."""
    obx = F.filter(segments(F.col(raw)), lambda s: F.get(s, F.lit(0)) == "OBX")
    x = F.col("_obx")
    return messages.select("*", F.posexplode(obx).alias("obx_seq", "_obx")).select(
        *messages.columns, "obx_seq", _field(x, 2).alias("value_type"),
        blank_to_null(part(_field(x, 3), "^", 0)).alias("source_code"), blank_to_null(part(_field(x, 3), "^", 1)).alias("source_display"),
        blank_to_null(_field(x, 5)).alias("value"), _field(x, 5).try_cast("double").alias("value_quantity"), blank_to_null(part(_field(x, 6), "^", 0)).alias("value_unit"),
        part(_field(x, 7), "-", 0).try_cast("double").alias("reference_range_low"), part(_field(x, 7), "-", 1).try_cast("double").alias("reference_range_high"),
        blank_to_null(_field(x, 8)).alias("interpretation_code"), blank_to_null(_field(x, 11)).alias("observation_status"),
    )
