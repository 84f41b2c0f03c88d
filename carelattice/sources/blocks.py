"""Records that span lines, from files of any size: tasks read blocks of a file, and what a block's edges cut is stitched.

A reader of the session splits files at line ends (or another separator) into blocks of its partition size. Each block's
task puts its pieces together to records; a piece before a block's first record start is the rest of a record that began
in an earlier block. Only these rests and each block's last record - two rows a block - are ordered by file and joined.
Where the first record starts may depend on all that came before (within quotes, within brackets): then every block is
summed up for each state it could begin in, and a fold over the sums of a file's blocks says which one it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelattice.operators.shared import checkpoint

FILE = ["file_path", "file_name", "file_size"]
_NUMBERED = "file long, block long, idx long, last boolean, record binary"
_MADE = "file_path string, file_name string, file_size long, block long, idx long, last boolean, record binary"
#: Gets the pieces of a block and the state it begins in; gives (whether the record begins here, its pieces) of each record.
Cut = Callable[[Iterator[bytes], dict], Iterator[tuple[bool, list[bytes]]]]
#: What is known of a block, by file and block.
States = dict[tuple[str, int], dict]
#: Gives the records that a block's edges may cut (the rest of an earlier one, and the block's last), or all others.
Records = Callable[[bool], DataFrame]


def pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """file_path, file_name, file_size, block (where it starts), length, value: the pieces between separators (line ends)."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("length"), F.col("value").cast("binary").alias("value"),
    )


def numbered_pieces(spark: SparkSession, path: str, separator: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The pieces with a number, file, for their file's path and name, which are several times as long; and the files with it."""
    file = F.xxhash64("file_path").alias("file")
    files = spark.read.format("binaryFile").load(path).select(*(F.col(f"_metadata.{c}").alias(c) for c in FILE))  # no contents
    return pieces(spark, path, separator).select(file, "file_size", "block", "length", "value"), files.select(file, *FILE)


#: Bytes of a piece up to which it counts as short.
SHORT = 1 << 15


def short_pieces(spark: SparkSession, path: str, separator: str) -> bool:
    """Whether all pieces between separators are short. The reader is told to leave longer ones out, so that none is held whole: then a file's bytes are missing."""
    reader = spark.read.option("lineSep", separator).option("mapreduce.input.linerecordreader.line.maxlength", str(SHORT))
    size = F.sum(F.octet_length("value") + len(separator.encode()))
    read = reader.text(path).groupBy(F.input_file_name().alias("file")).agg(size.alias("read"))
    files = spark.read.format("binaryFile").load(path).select(F.input_file_name().alias("file"), F.col("_metadata.file_size").alias("file_size"))
    return files.join(read, "file", "left").filter(F.col("file_size") > F.coalesce("read", F.lit(0))).isEmpty()


def _slices(batches: Iterator[pa.RecordBatch], file: str = "file_path") -> Iterator[tuple[tuple, dict, pa.Array]]:
    """Rows of one block that come in one batch: the block, its columns, its pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start, path = np.asarray(batch.column("block")), batch.column(file)
        other = (start[1:] != start[:-1]) | np.asarray(pc.not_equal(path[1:], path[:-1]))
        cuts = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        values, rest = batch.column("value"), [c for c in batch.schema.names if c != "value"]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            info = {c: batch.column(c)[a].as_py() for c in rest}
            yield (info[file], info["block"]), info, values[a:b]


def blocks(batches: Iterator[pa.RecordBatch], file: str = "file_path") -> Iterator[tuple[dict, Iterator[bytes]]]:
    """The blocks of a task, one after another: the columns of its first row, and its pieces."""
    for _, runs in groupby(_slices(batches, file), key=itemgetter(0)):
        _, info, first = next(runs)
        yield info, chain(first.to_pylist(), chain.from_iterable(run[2].to_pylist() for run in runs))


def records_of_blocks(rows: DataFrame, cut: Cut, joiner: bytes, states: States | None = None, files: DataFrame | None = None) -> Records:
    """Each record of each block with its number in it (-1: the rest of an earlier one); a task's rows are in order.

    States go to the tasks with the code, so that pieces, which are many and short, are neither joined nor shuffled nor sorted.
    files: if rows are numbered_pieces, those that their numbers stand for.
    """
    known, own = states or {}, FILE if files is None else ["file"]

    def make(edges: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            size = 0
            for info, values in blocks(batches, own[0]):
                held, idx = None, -1
                for begins, found in cut(values, info | known.get((info[own[0]], info["block"]), {})):
                    if held is not None and (held[-1] < 0) == edges:
                        out.append((*held, False, joiner.join(text)))
                        size += len(out[-1][-1])
                    idx += begins
                    held, text = (*(info[c] for c in own), info["block"], idx if begins else -1), found
                    if size > 1 << 23 or len(out) >= 5000:
                        yield _batch(out, own)
                        out, size = [], 0
                if held is not None and edges:
                    out.append((*held, True, joiner.join(text)))
            yield _batch(out, own)

        if files is None:
            return rows.mapInArrow(run, _MADE)
        return rows.mapInArrow(run, _NUMBERED).join(F.broadcast(files), "file").select(*_NAMES)

    return make


def records_at(spark: SparkSession, path: str, starts: Callable[[pa.Array], pa.Array], joiner: bytes) -> Records:
    """Records of lines where a line alone says that one begins with it: starts marks those among many lines, which are joined at once.

    A line goes to the task's Python with a file number; names, several times as long, are joined to records.
    """
    file = spark.read.format("binaryFile").load(path).select(*(F.col(f"_metadata.{c}").alias(c) for c in FILE))  # no contents
    files = checkpoint(file.withColumn("file", F.monotonically_increasing_id()))
    rows = pieces(spark, path).join(F.broadcast(files.select("file_path", "file")), "file_path").select("file", "block", "value")

    def make(edges: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, runs in groupby(_slices(batches, "file"), key=itemgetter(0)):
                held, idx = [], -1
                for _, _, values in runs:
                    at = np.flatnonzero(starts(values))
                    first, after = (at[0], at[-1]) if len(at) else (len(values), len(values))
                    if first:
                        held.append(_joined(values, [0, first], joiner)[0].as_py())
                    if not len(at):
                        continue
                    if held and (idx < 0) == edges:
                        yield _records(key, [idx], False, [joiner.join(held)])
                    if len(at) > 1 and not edges:
                        yield _records(key, np.arange(idx + 1, idx + len(at)), False, _joined(values, at, joiner))
                    idx += len(at)
                    held = [_joined(values, [after, len(values)], joiner)[0].as_py()]
                if edges:
                    yield _records(key, [idx], True, [joiner.join(held)])

        made = rows.mapInArrow(run, _NUMBERED)
        return made.join(F.broadcast(files), "file").select(*_NAMES)

    return make


def _records(key: tuple[int, int], idx: Sequence[int], last: bool, records: pa.Array | list[bytes]) -> pa.RecordBatch:
    n = len(idx)
    same = [pa.repeat(pa.scalar(k, pa.int64()), n) for k in key]
    return pa.RecordBatch.from_arrays([*same, pa.array(idx, pa.int64()), pa.repeat(last, n), pa.array(records, pa.binary())], names=["file", "block", "idx", "last", "record"])


def _joined(values: pa.Array, cuts: Sequence[int], joiner: bytes) -> pa.Array:
    """The values from each cut to the next one, joined."""
    first, last = int(cuts[0]), int(cuts[-1])
    offsets = pa.array(np.asarray(cuts, dtype=np.int32) - first, pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values[first:last]), pa.scalar(joiner, values.type)).cast(pa.binary())


_NAMES = [x.split()[0] for x in _MADE.split(", ")]
_KINDS = {"file_path": pa.string(), "file_name": pa.string(), "file_size": pa.int64(), "file": pa.int64(), "block": pa.int64(), "idx": pa.int64(), "last": pa.bool_(), "record": pa.binary()}


def _batch(rows: list[tuple], own: list[str]) -> pa.RecordBatch:
    names = [*own, "block", "idx", "last", "record"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[n]) for c, n in zip(columns, names, strict=True)], names=names)


def stitched(made: Records, joiner: bytes) -> DataFrame:
    """file_path, file_name, file_size, arrival_seq (the record's number in its file, from 0), record.

    What stands before a file's first record counts as one if it isn't blank.
    """
    # two rows a block are kept, so that all that follows from them takes no further pass over the files; the pass for them hands over no other record
    edge = checkpoint(made(True))
    order = Window.partitionBy("file_path").orderBy("block", "idx")
    n = F.when(F.col("idx") >= 0, F.col("idx") + 1).otherwise(0)
    edge = edge.withColumns({"before": F.sum(n).over(order) - n, "of": F.sum((F.col("idx") >= 0).cast("long")).over(order)})
    piece = F.struct("block", "idx", "record", "before")
    parts = F.sort_array(F.collect_list(piece))  # a record's own pieces: one for each block it reaches over
    whole = edge.groupBy(*FILE, "of").agg(parts.alias("parts"))
    text = F.concat_ws(joiner.decode(), F.transform("parts", lambda p: p["record"].cast("string")))
    whole = whole.select(*FILE, "of", F.get("parts", F.lit(0)).alias("first"), text.alias("record"))
    # a preamble of its own shifts the numbers of its file
    shift = whole.filter("of = 0 and record rlike '\\\\S'").select("file_path", F.lit(1).alias("shift"))
    starts = edge.groupBy("file_path", "block").agg(F.min("before").alias("before"))
    shifted = lambda df: df.join(shift, "file_path", "left").withColumn("shift", F.coalesce("shift", F.lit(0)))
    inner = made(False).join(F.broadcast(shifted(starts)), ["file_path", "block"])  # a row for each block; records stay where they are
    inner = inner.select(*FILE, (F.col("before") + F.col("idx") + F.col("shift")).alias("arrival_seq"), F.col("record").cast("string").alias("record"))
    outer = shifted(whole).filter("of > 0 or shift = 1")
    seq = F.when(F.col("of") == 0, F.lit(0)).otherwise(F.col("first.before") + F.col("first.idx") + F.col("shift"))
    return inner.unionByName(outer.select(*FILE, seq.cast("long").alias("arrival_seq"), "record"))


def states_of(sums: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], state: str) -> States:
    """The state that each block after a file's first begins in. sums: file_path or file, block and what a block sums up to.

    fold gets the sums of one file's blocks in order, one row a block, and gives a frame of the file, block and the columns of `state`.
    """
    file, kind = sums.dtypes[0]
    states = sums.groupBy(file).applyInPandas(lambda pdf: fold(pdf.sort_values("block")), f"{file} {kind}, block long, {state}")
    return {(r[file], r["block"]): r.asDict() for r in states.filter("block > 0").collect()}  # one row a block
