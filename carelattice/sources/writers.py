"""Sinks: tables with declared schemas, appended by position or replaced by run, and JSON."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from carelattice.operators.shared import delete, numbered, shared_folder
from carelattice.schemas import TABLES, ddl


def create_tables(spark: SparkSession, database: str, names: list[str] | None = None) -> None:
    """Create the database and its tables where they don't exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names or TABLES:
        spark.sql(ddl(f"{database}.{name}", TABLES[name], "pipeline_run_id"))


def clone_tables(spark: SparkSession, source: str, target: str) -> None:
    """The definitions of all tables of source, without rows, in target."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    for t in spark.catalog.listTables(source):
        if not t.isTemporary:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {target}.{t.name} LIKE {source}.{t.name}")


def _column(df: DataFrame, field: StructField) -> Column:
    return (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the schema's columns, in its order and types; missing ones are null."""
    return df.select(*(_column(df, f) for f in schema))


def append(df: DataFrame, table: str) -> None:
    """Append by position, after conforming to the table's schema; no rows write nothing."""
    schema = df.sparkSession.table(table).schema
    conform(df, schema).write.mode("append").insertInto(table)


def clear_run(spark: SparkSession, table: str, run_id: str) -> None:
    """Take a run's rows out of a table: its partition is overwritten with nothing."""
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in spark.table(table).schema if f.name != "pipeline_run_id")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (pipeline_run_id = {{run}}) SELECT {nothing} WHERE false".replace("{run}", "'" + run_id.replace("\\", "\\\\").replace("'", "\\'") + "'"))


def replace_run(rows: DataFrame, table: str, run_id: str) -> None:
    """Put rows in the place of what a run has in a table, by one commit: readers see the old rows or the new ones.

    rows are all of this run and don't read the table.
    """
    rows = conform(rows.withColumn("pipeline_run_id", F.lit(run_id)), rows.sparkSession.table(table).schema)
    if rows.isEmpty():
        clear_run(rows.sparkSession, table, run_id)
    else:
        conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # only the partitions that rows are of
        try:
            rows.write.insertInto(table, overwrite=True)
        finally:
            conf.set(mode, before)


class Staging:
    """What a stage writes, kept in the shared folder until the stage is over, then put in place table by table.

    A stage that fails leaves the tables as they were. Rows of audit tables are of several stages: those that aren't of
    this stage's sources or targets stay.
    """

    def __init__(self, spark: SparkSession, database: str, run_id: str):
        self.spark, self.database, self.run_id = spark, database, run_id
        self.folder, self.parts = shared_folder(spark, f"staged-{uuid.uuid4()}"), {}
        self.waiting: dict[str, list[DataFrame]] = {}

    def add(self, rows: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
        """Write rows (and the columns `extra`, which the table doesn't have) for table; the written rows."""
        path = f"{self.folder}/{table}/{len(self.parts.setdefault(table, []))}"
        schema = self.spark.table(f"{self.database}.{table}").schema
        rows.select(*(_column(rows, f) for f in schema), *(c for c in extra if c not in schema.names)).write.parquet(path)
        self.parts[table].append(path)
        return self.spark.read.parquet(path)

    def add_all(self, frames: list[DataFrame], table: str) -> DataFrame:
        """Write several frames for a table together; the written rows."""
        schema = self.spark.table(f"{self.database}.{table}").schema
        return self.add(reduce(DataFrame.unionByName, [conform(df, schema) for df in frames]), table)

    def later(self, rows: DataFrame, table: str) -> None:
        """Rows for a table that many frames of a stage write to: they are written together when the stage finishes."""
        self.waiting.setdefault(table, []).append(rows)

    def finish(self) -> None:
        for table, frames in self.waiting.items():
            self.add_all(frames, table)
        self.waiting = {}

    def commit(self, tables: tuple[str, ...], owned: dict[str, Column] | None = None) -> None:
        """Replace the run's rows of all tables; of those in `owned`, only the rows that its condition picks."""
        for table in dict.fromkeys([*tables, *self.parts]):
            name = f"{self.database}.{table}"
            current = self.spark.table(name)
            rows = self.spark.createDataFrame([], current.schema)
            for path in self.parts.get(table, ()):
                rows = rows.unionByName(conform(self.spark.read.parquet(path), current.schema))
            if owned and table in owned:
                kept = f"{self.folder}/{table}/kept"
                current.filter((F.col("pipeline_run_id") == self.run_id) & ~F.coalesce(owned[table], F.lit(False))).write.parquet(kept)
                rows = rows.unionByName(conform(self.spark.read.parquet(kept), current.schema))
            replace_run(rows, name, self.run_id)
        self.close()

    def close(self) -> None:
        delete(self.spark, self.folder)


def truncate(spark: SparkSession, tables: list[str], environment: str) -> None:
    """Empty tables, in the dev environment only."""
    if environment == "dev":
        for t in tables:
            spark.sql(f"TRUNCATE TABLE {t}")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """Write the records in this order as one JSON array: the parts of the folder, in the order of their names.

    Each record stands on a line of its own, behind the bracket or comma that precedes it, so that parts are written by
    many tasks and joined by reading one after another; Spark's commit makes them visible together. No rows give `[` and `]`.
    """
    lines = numbered(df.select(F.struct(*df.columns).alias("r"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(order))), [f"_{i}" for i in range(len(order))])
    text = F.concat(F.when(F.col("arrival_seq") == 0, "[").otherwise(","), F.to_json("r", {"ignoreNullFields": "false"}))
    lines = lines.select("arrival_seq", text.alias("value"))
    end = df.sparkSession.range(1).select(F.lit((1 << 63) - 1).alias("arrival_seq"), F.lit("[]" if df.isEmpty() else "]").alias("value"))
    lines.unionByName(end).repartitionByRange("arrival_seq").sortWithinPartitions("arrival_seq").select("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
