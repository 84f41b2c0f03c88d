"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import gc
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once in a Python worker; one longer document is handled whole.
SLICE_BYTES = 1 << 20
#: Ids that are null take part under this number and come back as null.
NULL_ID = (1 << 63) - 1
#: Where every row without an id has to be told from the others, they are numbered from here on; ids have to be less.
NULL_FROM = 1 << 62
#: Most bits of an id filter (128 MB); it is smaller where fewer ids need less.
FILTER_BITS = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; only a local session (tests) that names none gets a temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Delete the files of checkpoints that nothing reads any more."""
    for df in frames:
        plan = df._jdf.queryExecution().logical()
        file = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
        if file is not None and file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Free the disk of finished steps: shuffle files go when the driver's JVM has collected what refers to them."""
    gc.collect()
    spark._jvm.System.gc()


def partitions_for(df: DataFrame, bytes_each: int = 16 << 20, most: int = 100_000) -> int:
    """Shuffle partitions for data derived from df: follows the session and the size Spark knows of."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(size // bytes_each + 1, most)) if size < 1 << 60 else least


def held_out(id_col: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo modulus, equals remainder; a null id counts as ''."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns `id` and `text`, whatever else docs has; null text is empty, null ids become NULL_ID."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def own_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id_and_text in which each row without an id has a number of its own, from NULL_FROM on: after all others, and distinct.

    Such rows (usually none) are written out once, so that they keep their numbers however often they are read.
    """
    rows = id_and_text(docs, id_col, text_col)
    missing = docs.filter(F.col(id_col).isNull()).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if missing.isEmpty():
        return rows
    numbered = checkpoint(missing.select((F.lit(NULL_FROM) + F.monotonically_increasing_id()).alias("id"), "text"))
    return rows.filter(F.col("id") != NULL_ID).unionByName(numbered)


def restore_own(col: str = "id") -> Column:
    return F.when(F.col(col) < NULL_FROM, F.col(col))


def restore_id(col: str = "id") -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


def text_digest(text_col: str) -> Column:
    """Tells rows of one id apart by their text; null text is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch cut by rows so that a piece holds about `most` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
        at = 0
        for cut in [*cuts.tolist(), batch.num_rows]:
            if cut > at:
                yield batch.slice(at, cut - at)
                at = cut


class WordHashes(dict):
    """64-bit hashes of byte strings, remembered up to a bounded number of entries."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2^64, of all runs of k word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= BASE
        out += hashes[j : n + j]
    return mix(out)


def split_words(text: str) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def id_filter(ids: DataFrame, col: str = "id") -> bytes:
    """A one-hash Bloom filter over ids: 16 bits for each, FILTER_BITS at most; more ids only mean more false hits."""
    size = min(FILTER_BITS, max(1 << 16, 1 << (16 * ids.count()).bit_length()))
    at = filter_position(size, col) + 1
    rows = (
        ids.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator()
    )
    out = np.zeros(size // 8, np.uint8)
    for row in rows:
        start = (row.bucket - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return out.tobytes()


def filter_position(size: int, col: str = "id") -> Column:
    """The place of an id in a filter of so many bits."""
    return F.pmod(F.xxhash64(F.col(col)), F.lit(size))


def may_contain(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
