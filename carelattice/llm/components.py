"""Connected components by alternating large-star and small-star steps, entirely in Spark.

Each step rewires every node's larger (or smaller) neighbours to the least node it knows, so a chain of any length
takes a number of steps that grows with its logarithm. The edges of a step are written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, release


def _mark(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).cast("string")).first())


def components(edges: DataFrame) -> DataFrame:
    """id, component (least id) of every node of an edge. edges: u, v, in any direction; loops are ignored."""
    edges = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    before = None
    while (now := _mark(edges)) != before:
        before, old = now, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # every edge points down now: a node's smaller neighbours meet at the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = checkpoint(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")).filter("u <> v").distinct())
        release(old)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
