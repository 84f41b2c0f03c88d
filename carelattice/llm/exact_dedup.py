"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies meet in three steps, each of which groups by digest *and* full text:
1. within each input partition (the map side of the first aggregation),
2. within salted digest groups, so that one text that fills a third of the table is spread over SALTS tasks,
3. over the salt winners of a digest, of which there are at most SALTS for each text.

Only winners carry their text past step 2. The rows of the table then meet their class through skinny
(id, digest) rows, counted before they are shuffled and salted again.

Defined results: null text equals the empty text; a row without id ranks below every id (it is kept only if no equal
text has an id, and its keep_id is null then); rows with the same id and text are repeated rows, of which one is kept.
Different texts with one digest stay apart: such digests are told apart by a further pass over their full texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

SALTS = 8
#: Rank of a null id: below every other one.
LOWEST = -(1 << 63)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("id"), text.alias("text"), digest(text).alias("digest"))


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each text: digest, text, keep (largest id), size."""
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        .groupBy("digest", "text", "salt").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
    )
    return salted.groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, digest (binary).

    digest may be any function of the text; a weak one costs time and changes no result.
    """
    rows = _rows(docs, id_col, text_col, digest)
    by_digest = checkpoint(
        _classes(rows).groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep").alias("keep"), F.max("size").alias("size")).filter("texts > 1 or size > 1")
    )
    counted = rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    spread = by_digest.select("digest", "texts", "keep", "size", F.explode(F.array([F.lit(i) for i in range(SALTS)])).alias("salt"))
    found = counted.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(spread, ["digest", "salt"], "left")
    one = found.filter("texts is null or texts = 1").select("id", "digest", "copies", F.coalesce("keep", "id").alias("keep"), F.coalesce("size", "copies").alias("size"))
    if not by_digest.filter("texts > 1").isEmpty():
        shared = rows.join(by_digest.filter("texts > 1").select("digest"), "digest", "left_semi")
        classes = _classes(shared)
        own = shared.groupBy("id", "digest", "text").agg(F.count(F.lit(1)).alias("copies"))
        one = one.unionByName(own.join(classes, ["digest", "text"]).select("id", "digest", "copies", "keep", "size"))
    no_null = lambda c: F.when(F.col(c) != LOWEST, F.col(c))
    return one.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"), "*").select(
        no_null("id").alias("id"), no_null("keep").alias("keep_id"), F.col("size").alias("group_size"), ((F.col("id") == F.col("keep")) & (F.col("nth") == 1)).alias("kept"), "digest"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever their names.

    A row without id stays only if no equal text has an id; of repeated rows (equal id and text) one stays.
    """
    groups = exact_dedup(docs, id_col, text_col).groupBy(F.coalesce("id", F.lit(LOWEST)).alias("one"), F.col("digest").alias("of"))
    seen = checkpoint(groups.agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")).filter("not stays or rows > 1"))
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("one"), sha256(F.coalesce(F.col(text_col), F.lit(""))).alias("of"))
    out = out.join(seen.filter("not stays").select("one", "of"), ["one", "of"], "left_anti")
    if not seen.filter("stays").isEmpty():  # repeated rows, of which one stays
        out = out.dropDuplicates(["one", "of"])
    return out.select("doc.*")
