"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "carelattice", **conf: str) -> SparkSession:
    """UTC, ANSI arithmetic, adaptive plans, and the last of equal map keys."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
