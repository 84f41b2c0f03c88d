"""Which documents hold a 64-bit key that also occurs in another document, for many keys a document.

A key costs 7 bytes of shuffle: map tasks gather keys in chunks, find repeats within a chunk themselves, and send one
document for each key of a chunk as packed columns. So a key that a third of all documents share arrives once for each
chunk, not once for each document. A partition of the shuffle then holds all of its keys' chunk winners, sorts them
with numpy and answers with the documents concerned. Keys are compared on 56 bits and their partition's share of the
upper bits, about 62 bits in all.

There is a part for each 16 MB of input, however many that are. Beyond TASKS parts several share a task, which gets them
sorted and holds one at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, partitions_for, slices

#: Keys that a map task gathers before it sends them.
CHUNK = 2_000_000
#: Most tasks of a shuffle.
TASKS = 100_000
LOW = np.uint64((1 << 56) - 1)


def pack7(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def unpack7(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel().astype(np.uint64)


def _groups(keys: np.ndarray, ids: np.ndarray, earlier: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key's winner (keys, smallest ids), and which (ids, keys) are answered: those of a later document, or all of a key with two documents."""
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], ids[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, int)
    sizes = np.diff(np.append(starts, len(k)))
    least = np.minimum.reduceat(d, starts) if len(k) else d
    if earlier:
        told = d > np.repeat(least, sizes)
    else:
        told = np.repeat((np.maximum.reduceat(d, starts) if len(k) else d) > least, sizes)
    return k[starts], least, d[told], k[told]


def _packed(keys: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Keys in the order of their ids, the ids and how many keys each has."""
    order = np.argsort(ids, kind="stable")
    found, runs = np.unique(ids, return_counts=True)
    return pack7(keys[order]), runs.astype("<u4").tobytes(), found.astype("<i8").tobytes()


def _runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and stop of each run of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, int)
    return zip(x[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(x)], strict=False)


def _by_document(keys: np.ndarray, ids: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Answers dealt by document: one row for each of `parts` groups of ids, whatever the number of ids."""
    part = (mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    keys, ids = keys[order], ids[order]
    for i, a, b in _runs(part[order]):
        yield i, *_packed(keys[a:b], ids[a:b])


def shared_keys(rows: DataFrame, keys_of: Callable[[str], np.ndarray], earlier: bool) -> DataFrame:
    """id, keys (packed, 7 bytes each): one row for each document that has any. rows: id, text.

    earlier: keys of which a document with a smaller id has a copy; otherwise those that any other id has.
    """
    parts = partitions_for(rows, most=1 << 31)
    tasks = min(parts, TASKS)
    in_turn = parts > tasks
    columns = {"part": pa.int32(), "told": pa.bool_(), "keys": pa.binary(), "runs": pa.binary(), "ids": pa.binary()}
    schema = "part int, told boolean, keys binary, runs binary, ids binary"

    def batches_of(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(out), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 500], strict=True), columns.values(), strict=True)], names=list(columns))

    def send(keys: list[np.ndarray], ids: list[int], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        k, d, told, told_keys = _groups(np.concatenate(keys), np.repeat(np.array(ids, np.int64), sizes), earlier)
        out = [(i, True, *x) for i, *x in _by_document(told_keys, told, parts)]
        out += [(i, False, *_packed(k[a:b], d[a:b])) for i, a, b in _runs((k >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32))]
        yield from batches_of(out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, sizes, count = [], [], [], 0
        for batch in slices(batches):
            for one, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = keys_of(text)
                if len(found):
                    keys.append(found)
                    ids.append(one)
                    sizes.append(len(found))
                    count += len(found)
            if count >= CHUNK:
                yield from send(keys, ids, sizes)
                keys, ids, sizes, count = [], [], [], 0
        if count:
            yield from send(keys, ids, sizes)

    def deal(df: DataFrame) -> DataFrame:
        dealt = df.repartitionById(tasks, F.pmod("part", F.lit(tasks)))
        return dealt.sortWithinPartitions("part") if in_turn else dealt

    def take(packed: bytes, runs: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        return unpack7(packed), np.repeat(np.frombuffer(ids, "<i8"), np.frombuffer(runs, "<u4"))

    def answer(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        k, d = map(np.concatenate, zip(*held, strict=True))
        _, _, told, told_keys = _groups(k, d, earlier)
        yield from batches_of([(i, True, *x) for i, *x in _by_document(told_keys, told, parts)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            ready = []
            for part, told, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if told:
                    ready.append((part, True, *packed))
                    continue
                if in_turn and part not in held:
                    for done in list(held):
                        yield from answer(held.pop(done))
                held.setdefault(part, []).append(take(*packed))
            yield from batches_of(ready)
        for part in list(held):
            yield from answer(held.pop(part))

    def whole(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, ids = map(np.concatenate, zip(*held, strict=True))
        order = np.argsort(ids, kind="stable")
        keys, ids = keys[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])).tolist()
        for i in range(0, len(starts), 2000):
            part = [*starts[i : i + 2001], len(ids)][:2001]
            yield pa.RecordBatch.from_arrays([pa.array(ids[part[:-1]]), pa.array([pack7(np.unique(keys[a:b])) for a, b in zip(part[:-1], part[1:], strict=True)], pa.binary())], names=["id", "keys"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for part, *packed in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "runs", "ids")), strict=True):
                if in_turn and held and part != at:
                    yield from whole(held)
                    held = []
                at = part
                held.append(take(*packed))
        if held:
            yield from whole(held)

    dealt = deal(rows.mapInArrow(gather, schema)).mapInArrow(meet, schema)
    return deal(dealt).mapInArrow(join, "id long, keys binary")
