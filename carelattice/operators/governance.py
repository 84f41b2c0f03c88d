"""Tenant scoping, pseudonyms and operator-only views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import hash_umpi


def tenant_view(df: DataFrame, tenant: str | None, is_operator: bool = False, name: str | None = None) -> DataFrame:
    """The rows that this tenant may see; operators see all, and without a tenant nobody sees any. name: also a temp view."""
    out = df if is_operator else df.filter(F.col("tenant_id") == F.lit(tenant))
    if name:
        out.createOrReplaceTempView(name)
    return out


def current_user_view(df: DataFrame) -> DataFrame:
    """Rows whose tenant is the session's user."""
    return df.filter(F.col("tenant_id") == F.current_user())


def operator_only(df: DataFrame, is_operator: bool) -> DataFrame:
    if not is_operator:
        raise PermissionError("this view spans tenants and is for operators only")
    return df


def pseudonymise(df: DataFrame, column: str = "umpi", into: str = "patient_hash") -> DataFrame:
    return df.withColumn(into, hash_umpi(F.col(column))).drop(column)


def uscdi_view(summary: DataFrame) -> DataFrame:
    return summary.select("patient_hash", "tenant_id", "gender", "age", "postal_code", "risk_tier", "last_encounter_date")


def last_four(df: DataFrame, column: str) -> DataFrame:
    """A social security number by its last four digits only."""
    return df.withColumn(column, F.right(F.translate(column, "- ", ""), F.lit(4)))
