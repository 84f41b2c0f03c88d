"""Local names and codes to LOINC, RxNorm and SNOMED CT: literal maps, so no join and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.codes import LOINC, RXNORM, SNOMED
from carelattice.functions.columns import lookup, stable_id, strip


#: Fixed value: the coding system of LOINC.
LOINC_SYSTEM = "http://loinc.org"


def loinc(name: Column) -> Column:
    return lookup(F.lower(strip(name)), LOINC)


def rxnorm(name: Column) -> Column:
    return lookup(F.lower(strip(name)), RXNORM)


def snomed(code: Column) -> Column:
    return lookup(strip(code), SNOMED)


def normalize_observations(rows: DataFrame) -> DataFrame:
    """rows with loinc_code and normalization_method: the source's own LOINC, else the display's, else UNMAPPED."""
    mapped = loinc(F.col("source_display"))
    given = F.nullif(F.col("given_loinc"), F.lit(""))
    return rows.withColumns({
        "loinc_code": F.coalesce(given, mapped),
        "normalization_method": F.when(given.isNotNull(), "SOURCE_LOINC").when(mapped.isNotNull(), "TERMINOLOGY_SERVICE").otherwise("UNMAPPED"),
    })


def code_labs(rows: DataFrame) -> DataFrame:
    """Laboratory rows with loinc_code: by their code, else by their name."""
    by_code, by_name = loinc(F.col("source_code")), loinc(F.col("source_display"))
    return rows.withColumns({
        "loinc_code": F.coalesce(by_code, by_name),
        "normalization_method": F.when(by_code.isNotNull(), "SOURCE_LOINC").when(by_name.isNotNull(), "TERMINOLOGY_SERVICE").otherwise("UNMAPPED"),
    })


def normalization_log(coded: DataFrame, source: str = "", target: str = "", version: str = "", record: str = "source_record_id") -> DataFrame:
    """The 15 audit fields of each normalisation: one row for each LOINC coding of the source, else one for the look-up.

    The look-up's source value is the display, its system the source's coding system or LOCAL; mapped values are LOINC.
    """
    kind = "struct<value:string,system:string,code:string,method:string>"
    entry = lambda value, system, code, method: F.struct(value.alias("value"), system.alias("system"), code.alias("code"), F.lit(method).alias("method"))
    none = F.lit(None).cast("string")
    column = lambda name: F.col(name) if name in coded.columns else none
    local = F.coalesce(F.nullif(column("source_code_system"), F.lit("")), F.lit("LOCAL"))
    looked_up = F.array(F.when(F.col("loinc_code").isNotNull(), entry(F.col("source_display"), local, F.col("loinc_code"), "TERMINOLOGY_SERVICE")).otherwise(entry(F.col("source_display"), local, none, "UNMAPPED")))
    if "loinc_codings" in coded.columns:
        entries = F.transform("loinc_codings", lambda c: entry(c["code"], c["system"], c["code"], "SOURCE_LOINC"))
    else:
        entries = F.when(F.col("normalization_method") == "SOURCE_LOINC", F.array(entry(F.col("source_code"), local, F.col("loinc_code"), "SOURCE_LOINC"))).otherwise(F.array().cast(f"array<{kind}>"))
    entries = F.when(F.size(entries) > 0, entries).otherwise(looked_up)
    out = coded.select("*", F.posexplode(entries).alias("entry", "_log"))
    code = F.col("_log.code")
    return out.select(
        stable_id(record, "entry").alias("log_id"), column("tenant_id").alias("tenant_id"), F.lit(source).alias("source_table"), F.col(record).alias("source_id"), F.lit(target).alias("target_table"), column("observation_id").alias("target_id"), F.lit("LOINC_MAP").alias("mapping_type"),
        F.col("_log.value").alias("source_value"), F.col("_log.system").alias("source_system"), code.alias("mapped_value"), F.when(code.isNotNull(), LOINC_SYSTEM).alias("mapped_system"), F.when(code.isNotNull(), 1.0).otherwise(0.0).alias("mapping_confidence"),
        F.col("_log.method").alias("mapping_method"), F.lit(version).alias("pipeline_version"), F.current_timestamp().alias("processed_ts"),
    )


def mapped(coded: DataFrame) -> DataFrame:
    return coded.filter("loinc_code is not null")


def unmapped(coded: DataFrame, record: str = "source_record_id") -> DataFrame:
    """One row for each record without a target code; its source code is UNKNOWN if it has none."""
    return coded.filter("loinc_code is null").select(
        stable_id(record, F.lit("LOINC")).alias("unmapped_id"), F.col(record).alias("source_record_id"), F.coalesce(F.nullif("source_code", F.lit("")), F.lit("UNKNOWN")).alias("source_code"), "source_display", F.lit("LOINC").alias("target_vocabulary"), F.lit(1).alias("occurrence_count")
    )

