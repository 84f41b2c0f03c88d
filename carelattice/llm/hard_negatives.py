"""Hard negatives for contrastive training: rows of another label that an anchor finds nearly as similar as a positive.

Each anchor's scores with all rows are sorted by score, then id; its positives are the first rows of its own label, and for
each positive a binary search finds where scores come under its upper limit: the first rows of another label from there on,
above the lower limit, are its negatives. An anchor's scores are never held at once: rows travel as blocks of BLOCK packed
vectors, anchors in chunks of CHUNK; every chunk meets every block in bounded groups (chunk, salt), each group sorts the
scores of its own blocks and keeps the first few, and the groups' winners are ranked together. The first k of the whole
order are among the first k of each group, so nothing is lost. The work is all anchors times all rows, as defined.

Scores are integer inner products, exact: by BLAS where they stay below 2^53, in 64-bit integers beyond; what doesn't fit
64 bits is cut to their ends. Defined results: rows without id, label or vector, or with a component that is null or not
finite, take no part. Shorter vectors count as filled up with zeros. Every row counts for itself: of rows that share an id,
each can be an anchor and another's positive; the order among equal score and id doesn't show in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

#: Rows of a block, anchors of a chunk, blocks that meet a chunk in one task, and anchors whose scores a task holds at once.
BLOCK, CHUNK, TOGETHER, HELD = 4096, 16384, 4, 256
#: Components are scaled by this and rounded down.
SCALE = 256
_PAIRS = "anchor long, anchor_id long, positive int, positive_id long, positive_score long, score long, id long"


def _matrix(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of different lengths as one matrix, filled up with zeros."""
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def blocks(rows: DataFrame) -> DataFrame:
    """rows (id, label, anchor, vector) as blocks: block, n, width, narrow, ids, labels, anchors, values (row by row)."""
    schema = "block long, n int, width int, narrow boolean, ids binary, labels binary, anchors binary, vectors binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                vector = batch.column("vector")
                flat = np.asarray(vector.flatten().cast(pa.float64()).fill_null(np.nan), np.float64)
                sizes = np.asarray(pc.list_value_length(vector), np.int64)
                with np.errstate(over="ignore", invalid="ignore"):
                    values = np.floor(flat * SCALE)
                bad = np.zeros(len(sizes), bool)
                bad[np.repeat(np.arange(len(sizes)), sizes)[~np.isfinite(values)]] = True
                keep = ~bad
                if not keep.any():
                    continue
                m = _matrix(values[np.repeat(keep, sizes)], sizes[keep])
                narrow = bool((np.abs(m) < 32768).all())
                ids, labels, anchors = (np.asarray(batch.column(c))[keep] for c in ("id", "label", "anchor"))
                row = [count, len(ids), m.shape[1], narrow, ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), anchors.astype(np.uint8).tobytes(), m.astype("<i2" if narrow else "<f8").tobytes()]
                count += 1
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row[:1]] + [pa.array([x], pa.int32()) for x in row[1:3]] + [pa.array([x]) for x in row[3:]], names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(pack, schema)


def _vectors(n: int, width: int, narrow: bool, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i2" if narrow else "<f8").reshape(n, width).astype(np.float64)


def _anchors(packed: DataFrame) -> DataFrame:
    """One row for each anchor: anchor (a number of its own), anchor_id, label, width, narrow, vector."""
    schema = "anchor long, anchor_id long, label long, width int, narrow boolean, vector binary"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["anchors"], np.uint8))
                size = len(r["vectors"]) // r["n"]
                vectors = [r["vectors"][i * size : (i + 1) * size] for i in at.tolist()]
                columns = [pa.array(r["block"] * BLOCK + at), pa.array(np.frombuffer(r["ids"], "<i8")[at]), pa.array(np.frombuffer(r["labels"], "<i8")[at]), pa.array([r["width"]] * len(at), pa.int32()), pa.array([r["narrow"]] * len(at)), pa.array(vectors, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return packed.mapInArrow(unpack, schema)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact, as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in row] for row in a.tolist()], [[int(x) for x in row] for row in b.tolist()]
    cut = (1 << 63) - 1
    return np.array([[max(-cut, min(cut, sum(map(int.__mul__, x, y)))) for y in whole[1]] for x in whole[0]], np.int64).reshape(len(a), len(b))


def _groups(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """Scores of some anchors with a block's rows: ids, labels, numbers of the rows, scores, which anchors."""
    table = right.select(["width", "narrow", "vector"]).to_pylist()
    width = max((r["width"] for r in table), default=0)
    mine = np.zeros((len(table), width))
    for i, r in enumerate(table):
        mine[i, : r["width"]] = _vectors(1, r["width"], r["narrow"], r["vector"])[0]
    for i in range(left.num_rows):
        r = {c: left.column(c)[i].as_py() for c in ("block", "n", "width", "narrow", "ids", "labels", "vectors")}
        rows = _vectors(r["n"], r["width"], r["narrow"], r["vectors"])
        ids, labels, numbers = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8"), r["block"] * BLOCK + np.arange(r["n"])
        yield ids, labels, numbers, rows, mine


def _first(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of columns (group, score, id, ...), the first k of each group by score, then id."""
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    order = np.lexsort((columns[2], -columns[1], columns[0]))
    columns = [c[order] for c in columns]
    group = columns[0]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    return tuple(c[rank < k] for c in columns)


def _positives(packed: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """anchor, anchor_id, score, id: the first n other rows of an anchor's label, of each group of blocks."""
    schema = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own, anchor, anchor_id = (np.asarray(right.column(c)) for c in ("label", "anchor", "anchor_id"))
        found = []
        for ids, labels, numbers, rows, mine in _groups(left, right):
            for label in np.unique(own).tolist():
                at = np.flatnonzero(labels == label)
                same = np.flatnonzero(own == label)
                for part in np.array_split(same, len(same) // HELD + 1) if len(at) else ():
                    s = scores(mine[part], rows[at])
                    order = np.lexsort((np.broadcast_to(ids[at], s.shape), -s), axis=-1)[:, : n + 1]
                    took = np.take_along_axis(s, order, 1).ravel()
                    who, which = np.repeat(part, order.shape[1]), at[order.ravel()]
                    other = numbers[which] != anchor[who]
                    found.append((who[other], took[other], ids[which][other]))
        if not found:
            return schema.empty_table()
        who, score, ids = _first(found, n)
        return pa.table([anchor[who], anchor_id[who], score, ids], schema=schema)

    return _meet(packed, anchors, run, "anchor long, anchor_id long, score long, id long")


def _negatives(packed: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """The first k rows of another label within a positive's limits, of each group of blocks (columns of _PAIRS)."""
    schema = pa.schema([(x.split()[0], pa.int32() if x.endswith(" int") else pa.int64()) for x in _PAIRS.split(", ")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = np.asarray(right.column("label"))
        wanted = [[(p["positive"], int(p["score"])) for p in x] for x in right.column("positives").to_pylist()]
        slot = np.cumsum([0, *map(len, wanted)])
        found = []
        for ids, labels, _, rows, mine in _groups(left, right):
            for part in np.array_split(np.arange(len(own)), len(own) // HELD + 1):
                s = scores(mine[part], rows)
                order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=-1)
                for i, a in enumerate(part.tolist()):
                    line = order[i]
                    line = line[labels[line] != own[a]]
                    falling = -s[i, line]
                    for j, (_, p) in enumerate(wanted[a]):
                        upper, lower = high * p // 100, -(-low * p // 100)
                        if upper < lower:
                            continue
                        at = int(np.searchsorted(falling, -upper, "left"))
                        took = line[at : at + k]
                        took = took[s[i, took] >= lower]
                        if len(took):
                            found.append((np.full(len(took), slot[a] + j), s[i, took], ids[took]))
        if not found:
            return schema.empty_table()
        which, score, ids = _first(found, k)
        who = np.searchsorted(slot, which, "right") - 1
        flat = [p for x in right.column("positives").to_pylist() for p in x]
        chosen = [flat[i] for i in which.tolist()]
        columns = [np.asarray(right.column("anchor"))[who], np.asarray(right.column("anchor_id"))[who], [p["positive"] for p in chosen], [p["id"] for p in chosen], [p["score"] for p in chosen], score, ids]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return _meet(packed, anchors, run, _PAIRS)


def _meet(packed: DataFrame, anchors: DataFrame, run, schema: str) -> DataFrame:
    """run(blocks, anchors) for every chunk of anchors and every few blocks; a task holds CHUNK anchors and TOGETHER blocks, about."""
    chunks, salts = anchors.count() // CHUNK + 1, packed.count() // TOGETHER + 1
    left = packed.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.groupBy("chunk", "salt").cogroup(right.groupBy("chunk", "salt")).applyInArrow(run, schema)


def hard_negatives(
    rows: DataFrame, anchors: Column, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5, k: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchors: which rows are anchors. low, high: limits of a negative's score in percent of the positive's, inclusive.
    """
    used = rows.select(F.col(id_col).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vector"))
    packed = checkpoint(blocks(used.filter("id is not null and label is not null and vector is not null")))
    mine = checkpoint(_anchors(packed))
    near = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = _positives(packed, mine, positives).withColumn("positive", F.row_number().over(near)).filter(F.col("positive") <= positives)
    listed = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive", "score", "id"))).alias("positives"))  # as many as `positives`
    asked = checkpoint(mine.join(listed, "anchor"))
    ranked = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    found = _negatives(packed, asked, k, low, high).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
