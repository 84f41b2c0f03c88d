"""Documents to packed training sequences: each stage takes what its predecessor kept and lets its decisions take effect.

Every stage gets (spark, docs, sf_dir) and returns the columns of documents, but for the last, which returns the packed
pieces. run() writes what a stage returns as Parquet into the shared checkpoint folder and reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from carelattice.llm.common import ensure_checkpoint_dir, table
from carelattice.llm.decontamination import drop_contaminated
from carelattice.llm.exact_dedup import drop_exact_copies
from carelattice.llm.near_dedup import drop_near_duplicates
from carelattice.llm.packing import pack
from carelattice.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic passage; null and empty texts stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the row with the largest id; one of those that share it."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; texts too short for shingles stay."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null texts, missing and repeated ids stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence; a null text is its end token alone."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: SQL can't express tokenisation, segment statistics or banded alignment; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/corpus-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
