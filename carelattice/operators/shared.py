"""Numbers of a whole order, and the shared folder that iterative operators write to."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; only a local session that names none gets a temporary one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this name below the one that the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}"


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with arrival_seq, their number in this order: sorted by ranges, then counted by partition; no single task."""
    parts = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33)))
    sizes = sorted((r["_p"], r["n"]) for r in parts.groupBy("_p").agg(F.count("*").alias("n")).collect())  # one row a partition
    starts, at = {}, 0
    for p, n in sizes:
        starts[p], at = at, at + n
    offsets = rows.sparkSession.createDataFrame(list(starts.items()), "_p int, _start long")
    return parts.join(F.broadcast(offsets), "_p").withColumn("arrival_seq", F.col("_start") + F.col("_i")).drop("_p", "_i", "_start")
