"""Repeated passages by sparse suffix arrays.

Of a document's suffixes only those are kept that begin at a minimiser: the place with the least hash of K words among
SPAN successive places. Which places these are depends on the words around them alone, so two documents that share a
passage of LENGTH = K + SPAN - 1 words share a kept place within it.

1. Suffixes that begin with the same K words as a suffix of another document are found by shared_keys (sparse places
   only: about 2 / (SPAN + 1) of the words).
2. Only documents with such suffixes are read again. Each of their suffixes becomes a row with its first LENGTH words to
   the right and LENGTH - K words to the left, as hashes.
3. The rows are sorted by (first K words, words to the right, words to the left) over all tasks, and each is compared
   with its nearest rows of other documents: the match is extended to the right and to the left. A second order, by the
   words to the left first, finds partners that agree better there. What stands at the edge of a task is compared again
   with its neighbour across the edge. A match tells which windows of LENGTH words around the place are repeated.
4. The two orders give the longest matches to either side. Windows that these allow and no neighbour has (two documents
   agree there, but others agree more with each of them on one side) are looked up among all rows of their key.
5. A document's windows merge into maximal passages; a chain of kept places carries a longer passage as far as it goes.

Rows are dealt by ranges of the whole order, so a passage that a third of all documents share is spread over tasks.

Defined results: null texts and texts of fewer than LENGTH words have no passages; rows with equal ids count as one
document, rows without an id are documents of their own; a passage that only repeats within a document is none. Ids have to
be less than 2^62.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, filter_position, hash_words, id_filter, may_contain, own_ids, partitions_for, release, restore_own, rolling, slices, split_words
from .shared_keys import LOW, shared_keys, unpack7

K, SPAN = 18, 33
LENGTH = K + SPAN - 1
#: Words of context on either side of the first K.
SIDE = LENGTH - K
#: Keys to look up that are broadcast at most (16 bytes each).
SENT = 500_000
_NONE = np.int64((1 << 63) - 1)


def minimisers(keys: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Places with the least key (the leftmost of equals) of any `span` successive places."""
    n = len(keys) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    # least values of runs, by doubling; the place in the low bits makes ties leftmost
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(keys[order][1:] != keys[order][:-1])]) * len(keys)
    least, have = rank + np.arange(len(keys)), 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return np.unique(least % len(keys))


def places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, kept places and the keys (first K words) of their suffixes."""
    h = hash_words(words)
    keys = rolling(h, K)
    at = minimisers(keys)
    return h, at, keys[at]


def _context(words: np.ndarray, at: np.ndarray, step: int) -> pa.Array:
    """The SIDE words from each place on (step 1) or back (step -1), big-endian so that bytes sort as words do; zeros beyond the text."""
    where = at[:, None] + step * np.arange(SIDE)
    inside = (where >= 0) & (where < len(words))
    found = np.where(inside, words[np.clip(where, 0, max(0, len(words) - 1))], 0).astype(">u4")
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SIDE), len(at), [None, pa.py_buffer(found.tobytes())]).cast(pa.binary())


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for one, text, told in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "told")), strict=True):
            h, at, keys = places(split_words(text))
            some = np.isin(keys & LOW, unpack7(told))
            at, keys = at[some], keys[some].view(np.int64)
            words = np.maximum(h >> np.uint64(32), np.uint64(1)).astype(np.uint32)
            for i in range(0, len(at), 10_000):
                part = at[i : i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 10_000]), pa.array(np.full(len(part), one)), pa.array(part.astype(np.int32)), _context(words, part + K, 1), _context(words, part - 1, -1)], names=["key", "id", "at", "after", "before"])


class Rows(NamedTuple):
    """Suffixes: after and before as one row of SIDE words each."""

    key: np.ndarray
    id: np.ndarray
    at: np.ndarray
    after: np.ndarray
    before: np.ndarray

    def some(self, which) -> Rows:
        return Rows(*(x[which] for x in self))


def _rows(batch: pa.RecordBatch) -> Rows:
    def words(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(-1, SIDE)

    return Rows(*(batch.column(c).to_numpy() for c in ("key", "id", "at")), words("after"), words("before"))


def _joined(parts: list[Rows]) -> Rows:
    return parts[0] if len(parts) == 1 else Rows(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words at the start two contexts share, row by row."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(1), differ.argmax(1), SIDE)


def windows(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which windows of LENGTH words around a place a match covers: bit l is the window that begins l words before it."""
    one = np.int64(1)
    return np.where(right + left >= SIDE, (one << (left + 1)) - (one << np.maximum(SIDE - right, 0)), 0)


_COMPARED = "key long, id long, at int, after binary, before binary, covered long, right int, left int, partner long"
_NAMES = [x.split()[0] for x in _COMPARED.split(", ")]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: what each row shares with its nearest row of another document on both sides, if that has its key.

    Rows of one document and key that follow each other are a run; a row's neighbours are the last row before its run and
    the first after it. The first and last run of a task, and the row beside each, are handed on too, with their words,
    for the comparison across its edge.
    """
    held: list[Rows] = []  # the latest run
    beside: Rows | None = None  # the last row before it
    opening = True

    def edge(rows: Rows) -> pa.RecordBatch:
        n = len(rows.key)
        words = [pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SIDE), n, [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary()) for x in (rows.after, rows.before)]
        return pa.RecordBatch.from_arrays([*(pa.array(x) for x in (rows.key, rows.id, rows.at)), *words, *(pa.nulls(n, k) for k in (pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=_NAMES)

    def compared(rows: Rows, done: int, most: int) -> pa.RecordBatch:
        """Of rows done to most."""
        n = len(rows.key)
        change = np.flatnonzero((rows.key[1:] != rows.key[:-1]) | (rows.id[1:] != rows.id[:-1])) + 1
        starts, stops = np.concatenate([[0], change]), np.concatenate([change, [n]])
        run = np.repeat(np.arange(len(starts)), stops - starts)[done:most]
        mine = np.arange(done, most)
        covered, right, left, partner = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64), np.full(len(mine), _NONE)
        for other in (starts[run] - 1, stops[run]):
            there = (other >= 0) & (other < n)
            there[there] = rows.key[other[there]] == rows.key[mine[there]]
            i, j = mine[there], other[there]
            r, l = common(rows.after[i], rows.after[j]), common(rows.before[i], rows.before[j])
            found = windows(r, l)
            covered[there] |= found
            right[there], left[there] = np.maximum(right[there], r), np.maximum(left[there], l)
            partner[there] = np.where(found != 0, np.minimum(partner[there], rows.id[j]), partner[there])
        told = [rows.key[done:most], rows.id[done:most], rows.at[done:most]]
        return pa.RecordBatch.from_arrays([*(pa.array(x) for x in told), pa.nulls(len(mine), pa.binary()), pa.nulls(len(mine), pa.binary()), pa.array(covered), pa.array(right.astype(np.int32)), pa.array(left.astype(np.int32)), pa.array(partner)], names=_NAMES)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _rows(batch)
        change = np.flatnonzero((rows.key[1:] != rows.key[:-1]) | (rows.id[1:] != rows.id[:-1])) + 1
        if held and not len(change) and held[-1].key[-1] == rows.key[0] and held[-1].id[-1] == rows.id[0]:
            held.append(rows)
            continue
        rows = _joined([*([beside] if beside else []), *held, rows])
        done = 1 if beside else 0
        last = int((np.flatnonzero((rows.key[1:] != rows.key[:-1]) | (rows.id[1:] != rows.id[:-1])) + 1).max(initial=0))
        if last <= done:  # still the first run
            held = [rows.some(slice(done, None))]
            continue
        if opening:
            stop = int(np.flatnonzero((rows.key[1:] != rows.key[:-1]) | (rows.id[1:] != rows.id[:-1])).min()) + 2
            yield edge(rows.some(slice(0, stop)))
            opening = False
        yield compared(rows, done, last)
        beside, held = rows.some(slice(last - 1, last)), [rows.some(slice(last, None))]
    if held:
        rows = _joined([*([beside] if beside else []), *held])
        yield compared(rows, 1 if beside else 0, len(rows.key))
        yield edge(rows)


def _neighbours(rows: DataFrame, order: list[str], parts: int) -> list[DataFrame]:
    """What every row shares with its neighbours in this order: within tasks, then across their edges."""
    rows = rows.select("key", "id", "at", "after", "before")
    within = checkpoint(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_compare, _COMPARED))
    edges = within.filter("after is not null").select(rows.columns).repartition(1).sortWithinPartitions(*order).mapInArrow(_compare, _COMPARED)
    return [x.filter("after is null").select("key", "id", "at", "covered", "right", "left", "partner") for x in (within, edges)]


def _missed(seen: DataFrame, suffixes: DataFrame) -> DataFrame | None:
    """Windows that neither order can tell: a row agrees with one neighbour to the right and another to the left, so that a
    third, near in neither order, may share a window between. These windows are looked up as such."""
    bits = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1
    open_windows = bits(F.col("left") + 1).bitwiseAND(F.bitwise_not(bits(SIDE - F.col("right")))).bitwiseAND(F.bitwise_not("covered"))
    asked = seen.withColumn("open", open_windows).filter((F.col("right") + F.col("left") >= SIDE) & (F.col("open") != 0)).select("key", "id", "at", "open")
    asked = checkpoint(asked.select("key", "id", "at", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SIDE)), lambda l: F.call_function("shiftright", F.col("open"), l).bitwiseAND(1) == 1)).alias("l")))
    if asked.isEmpty():
        return None
    shape = lambda df: df.withColumn("a", F.substring("after", F.lit(1), 4 * (SIDE - F.col("l")))).withColumn("b", F.substring("before", F.lit(1), 4 * F.col("l"))).drop("after", "before")
    # few keys, as usual, are broadcast, so that a hot key's rows stay where they are; more are joined
    wanted = checkpoint(asked.select("key", "l").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    # rows with the same window combine before they are shuffled
    there = shape(suffixes.join(wanted, "key")).groupBy("key", "l", "a", "b").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    found = shape(asked.join(suffixes, ["key", "id", "at"])).join(there, ["key", "l", "a", "b"])
    return found.select("key", "id", "at", (bits(F.col("l")) + 1).alias("covered"), F.when(F.col("low") == F.col("id"), F.col("high")).otherwise(F.col("low")).alias("partner"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, first, stop (words), partner (least id of a neighbour with it) of every maximal repeated passage."""
    rows = own_ids(docs, id_col, text_col)
    found = checkpoint(shared_keys(rows, lambda text: places(split_words(text))[2], earlier=False))
    told = id_filter(found)
    bits, size = docs.sparkSession.sparkContext.broadcast(told), 8 * len(told)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(may_contain(known, batch.column("at").to_numpy()))).select(["id", "text"])

    some = rows.withColumn("at", filter_position(size)).mapInArrow(maybe, "id long, text string").join(found.withColumnRenamed("keys", "told"), "id")
    suffixes = checkpoint(some.mapInArrow(_suffixes, "key long, id long, at int, after binary, before binary"))
    release(found)
    parts = partitions_for(rows)
    seen = [*_neighbours(suffixes, ["key", "after", "before", "id", "at"], parts), *_neighbours(suffixes, ["key", "before", "after", "id", "at"], parts)]
    seen = checkpoint(
        reduce(DataFrame.unionByName, seen).groupBy("key", "id", "at")
        .agg(F.bit_or("covered").alias("covered"), F.max("right").alias("right"), F.max("left").alias("left"), F.min("partner").alias("partner")).filter(F.col("right") + F.col("left") >= SIDE)
    )
    spans = seen.filter("covered <> 0").select("id", "at", "covered", "partner")
    if (more := _missed(seen, suffixes)) is not None:
        spans = spans.unionByName(more.select("id", "at", "covered", "partner"))
    release(suffixes) if more is None else None
    return spans.repartition("id").sortWithinPartitions("id", "at").mapInArrow(_merge, "id long, first int, stop int, partner long").withColumns({"id": restore_own(), "partner": restore_own("partner")})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching windows of a document, in order, as one span."""
    held: list[tuple] = []

    def spans() -> list[list]:
        out: list[list] = []
        for first, stop, one, partner in sorted(held):
            if out and first <= out[-1][2]:
                out[-1][2], out[-1][3] = max(out[-1][2], stop), min(out[-1][3], partner)
            else:
                out.append([one, first, stop, partner])
        held.clear()
        return out

    for batch in batches:
        out = []
        for one, at, covered, partner in zip(*(batch.column(c).to_pylist() for c in ("id", "at", "covered", "partner")), strict=True):
            if held and held[0][2] != one:
                out += spans()
            low = 0
            while covered >> low:
                low += ((covered >> low) & -(covered >> low)).bit_length() - 1
                high = low + (~(covered >> low) & -~(covered >> low)).bit_length() - 2
                held.append((at - high, at - low + LENGTH, one, partner))
                low = high + 1
        yield _spans(out)
    if held:
        yield _spans(spans())


def _spans(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["id", "first", "stop", "partner"])
