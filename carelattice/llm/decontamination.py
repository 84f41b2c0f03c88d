"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping patterns of PATTERN characters (short items are one pattern). A pattern of m
characters that occurs with at most k = RATE * m edits shares at least m + 1 - q - k q of its q-grams with that place,
all on diagonals (place in the document minus place in the item) at most k apart. So shared q-grams are counted in
diagonal bands of width 2 k that overlap by half; only places that reach the bound are kept, and each of them is
verified by banded alignment of the whole pattern.

The index of the benchmark is broadcast in blocks of about BLOCK characters. One block is a single pass without shuffle;
of several each is a pass of its own that writes its hits, and its index is given up before the next is sent, so a
benchmark of any size is searched whole in bounded memory. Texts are compared in lower case with white space as single
spaces. An excerpt of PATTERN + STRIDE - 1 (143) characters of an item holds a whole pattern, so it is always found;
shorter excerpts are found if they hold one. Items of up to PATTERN + STRIDE / 2 characters are one pattern.

Defined results: null and empty texts and items match nothing, nor do items of fewer than q characters; an item
without an id is searched too and reported as null; repeated rows are judged each for itself; without a benchmark no document is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, checkpoint, id_and_text, mix, restore_id, slices, text_digest

Q = 10
PATTERN, STRIDE, RATE = 96, 48, 0.07
BLOCK = 2_000_000
#: Places of items that a text's q-grams have on average before it is searched pattern by pattern; diagonals of one alignment.
REPEATS, WIDEST = 32, 16_384
#: Tasks over which the rows of one text are spread where several blocks' hits are joined to them.
SALTS = 64
_BITS = 24


def characters(text: str) -> np.ndarray:
    return np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), "<u4")


def qgrams(chars: np.ndarray, q: int = Q, kind: type = np.uint64) -> np.ndarray:
    """Polynomial hashes of all q-grams, by doubling, modulo 2^64 (or what kind holds)."""
    if len(chars) < q:
        return np.empty(0, kind)
    base, whole = 0x9E3779B97F4A7C15, 1 << (8 * np.dtype(kind).itemsize)
    have, h = 1, chars.astype(kind)
    powers, out, done = {1: h}, None, 0
    while have * 2 <= q:
        h = h[: len(h) - have] * kind(pow(base, have, whole)) + h[have:]
        have *= 2
        powers[have] = h
    for size in sorted(powers, reverse=True):
        if q - done >= size:
            part = powers[size][done : done + len(chars) - q + 1]
            out = part.copy() if out is None else out * kind(pow(base, size, whole)) + part
            done += size
    return out


def patterns(length: int) -> list[tuple[int, int]]:
    """Start and stop of the patterns of an item."""
    if length <= PATTERN + STRIDE // 2:
        return [(0, length)] if length >= Q else []
    starts = [*range(0, length - PATTERN, STRIDE), length - PATTERN]
    return [(s, s + PATTERN) for s in dict.fromkeys(starts)]


def budget(m: int) -> int:
    """Edits allowed to a pattern: RATE of it, but few enough for the lemma to need a q-gram."""
    return min(int(RATE * m), (m - Q) // Q)


class Index:
    """q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.chars = [i for i, _ in items], [characters(t) for _, t in items]
        grams = [mix(qgrams(c)) for c in self.chars]
        keys = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.place = keys[order], item[order].astype(np.int64), place[order].astype(np.int64)
        self.some = np.zeros(1 << _BITS, bool)
        for c in self.chars:
            self.some[self._slots(c)] = True
        self.patterns = [[(a, b, self._bound(b - a)) for a, b in patterns(len(c))] for c in self.chars]
        self.need = np.array([min((n for *_, n in p), default=1 << 30) for p in self.patterns], np.int64)
        self.least = int(self.need.min(initial=1 << 30))
        self.reach = max(1, *(budget(b - a) for c in self.chars for a, b in patterns(len(c)))) if any(len(c) >= Q for c in self.chars) else 1

    @staticmethod
    def _slots(chars: np.ndarray) -> np.ndarray:
        """Places of all q-grams in the table that tells which may be an item's: 32-bit arithmetic, as most stop here."""
        return (qgrams(chars, Q, np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """find() for each text; texts are screened together, and those with too few possible q-grams end there."""
        folded = [" ".join(t.lower().split()) for t in texts]
        sizes = np.array([len(t) + 1 for t in folded])
        joined = np.frombuffer("\0".join(folded).encode("utf-32-le", "surrogatepass"), "<u4")  # no item has a NUL
        at = np.flatnonzero(self.some[self._slots(joined)]) if len(self.keys) else np.empty(0, np.int64)
        hits = np.bincount(np.searchsorted(np.cumsum(sizes), at, "right"), minlength=len(texts))
        return [self.find(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")) if n >= self.least else [] for t, n in zip(folded, hits.tolist(), strict=True)]

    def find(self, chars: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Verified places: item, first and stop in the text's characters, edits; the best of each pattern's band."""
        at = np.flatnonzero(self.some[self._slots(chars)])
        grams = mix(qgrams(chars)[at])
        low, high = np.searchsorted(self.keys, grams), np.searchsorted(self.keys, grams, "right")
        n = high - low
        if not n.sum():
            return []
        if n.sum() > REPEATS * len(at):
            return self._repetitive(chars, at[n > 0], grams[n > 0], low[n > 0], n[n > 0])
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, place, diagonal = self.item[which], self.place[which], np.repeat(at, n) - self.place[which]
        width, found, seen = 2 * self.reach, [], set()
        for shift in (0, self.reach):
            band = (diagonal + shift) // width
            order = np.lexsort((place, band, item))
            i, b = item[order], band[order]
            starts = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (b[1:] != b[:-1])]))
            stops = np.append(starts[1:], len(order))
            enough = stops - starts >= self.need[i[starts]]
            for s, e in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True):
                which_item, places = int(i[s]), place[order[s:e]]
                for x, y, need in self.patterns[which_item]:
                    a, z = np.searchsorted(places, [x, y - Q + 1])
                    if z - a < need or len(np.unique(places[a:z])) < need:
                        continue
                    d = diagonal[order[s + a : s + z]]
                    low, high = int(d.min()) + x, int(d.max()) + x
                    if (which_item, x, low, high) in seen:  # the other banding had the same place
                        continue
                    seen.add((which_item, x, low, high))
                    first, edits = self._align(self.chars[which_item][x:y], chars, low, high)
                    if edits <= budget(y - x):
                        found.append((self.ids[which_item], first, first + (y - x), edits))
        return sorted(set(found))

    def _repetitive(self, chars: np.ndarray, at: np.ndarray, grams: np.ndarray, low: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int, int]]:
        """find() where the text's q-grams stand in many places of the items, as rules and fillers do.

        The same bands are counted pattern by pattern, each place of a pattern once a band, so that memory follows the text
        and not the number of shared places; bands side by side are aligned as one interval, in parts of bounded width.
        """
        order = np.argsort(grams, kind="stable")
        at, sorted_grams = at[order], grams[order]
        runs = np.unique(np.stack([low, n]), axis=1)  # of equal q-grams once
        items = np.unique(np.concatenate([self.item[a : a + m] for a, m in runs.T.tolist()]))
        width, found = 2 * self.reach, set()
        for item in items.tolist():
            own = mix(qgrams(self.chars[item]))
            first, last = np.searchsorted(sorted_grams, own), np.searchsorted(sorted_grams, own, "right")
            for x, y, need in self.patterns[item]:
                places = [p for p in range(x, y - Q + 1) if last[p] > first[p]]
                if len(places) < need:
                    continue
                spans = []
                for shift in (0, self.reach):
                    zero = -(-(y + shift) // width) * width  # makes diagonals count from 0
                    counts = np.zeros((len(chars) + zero + shift) // width + 1, np.int16)
                    for p in places:
                        there = np.zeros(len(counts), bool)
                        there[(at[first[p] : last[p]] - p + shift + zero) // width] = True
                        counts += there
                    bands = np.flatnonzero(counts >= need) * width - shift - zero + x
                    spans += [(b, b + width - 1) for b in bands.tolist()]
                merged: list[list[int]] = []
                for a, z in sorted(spans):
                    if merged and a <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], z)
                    else:
                        merged.append([a, z])
                for a, z in merged:
                    for part in range(a, z + 1, WIDEST):
                        place, edits = self._align(self.chars[item][x:y], chars, part, min(z, part + WIDEST - 1))
                        if edits <= budget(y - x):
                            found.add((self.ids[item], place, place + (y - x), edits))
        return sorted(found)

    @staticmethod
    def _bound(m: int) -> int:
        return max(1, m + 1 - Q - budget(m) * Q)

    @staticmethod
    def _align(pattern: np.ndarray, chars: np.ndarray, low: int, high: int) -> tuple[int, int]:
        """Least edits of the whole pattern against a place that begins between low - k and high + k, in that band.

        The place may reach over either end of the text: what would lie there differs, which costs as much as a missing character.
        """
        k = budget(len(pattern))
        start = low - k
        # cell j of row i: pattern[:i] against text that ends at start + i + j; begins anywhere in the band
        row = np.zeros(high - low + 2 * k + 1, np.int64)
        ramp = np.arange(len(row))
        for i, c in enumerate(pattern.tolist()):
            ends = start + i + ramp
            same = np.zeros(len(row), bool)
            inside = (ends >= 0) & (ends < len(chars))
            same[inside] = chars[ends[inside]] == c
            step = np.minimum(row + ~same, np.append(row[1:], 1 << 30) + 1)
            row = np.minimum.accumulate(step - ramp) + ramp
        j = int(row.argmin())
        return max(0, start + (min(j, 2 * k) if high - low < 4 * k else j)), int(row[j])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark's different items in parts of about BLOCK characters."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(NULL_ID)).alias("item"), F.col(text_col).alias("text")).filter("text is not null").dropDuplicates()
    n = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // BLOCK + 1
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def _index(spark: SparkSession, block: DataFrame) -> Broadcast:
    return spark.sparkContext.broadcast(Index([(r.item, r.text) for r in block.collect()]))


_KIND = pa.list_(pa.struct([("item", pa.int64()), ("first", pa.int64()), ("stop", pa.int64()), ("edits", pa.int64())]))
_SPANS = "spans array<struct<item:long,first:long,stop:long,edits:long>>"


def _spans(found: list[list[tuple]]) -> pa.Array:
    return pa.array([[dict(zip(("item", "first", "stop", "edits"), (None if x[0] == NULL_ID else x[0], *x[1:]), strict=True)) for x in own] for own in found], _KIND)


def _hits(texts: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """digest, spans of the texts that hold a pattern of any block. texts: text, digest.

    A pass for each block: its index is given up before the next is sent, and only hits are written.
    """
    found = []
    for block in blocks:
        index = _index(texts.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                spans = index.value.search(batch.column("text").to_pylist())
                hit = pa.array([bool(x) for x in spans], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("digest"), _spans(spans)], names=["digest", "spans"]).filter(hit)

        found.append(checkpoint(texts.mapInArrow(run, f"digest binary, {_SPANS}").dropDuplicates(["digest"])))
        index.destroy()
    return reduce(DataFrame.unionByName, found).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _salted(rows: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with a salt: rows are dealt by turns and the few hits go to every salt, so that a text of very many rows is no hot key."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), hits.withColumn("salt", salts)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """id and spans (item, first and stop in the compared characters, edits) of every document; one block needs no shuffle."""
    blocks = _blocks(benchmark, item_col, item_text)
    rows = id_and_text(docs, id_col, text_col)
    if len(blocks) > 1:
        rows = rows.withColumn("digest", text_digest("text"))
        rows, hits = _salted(rows.select("id", "digest"), _hits(rows.select("text", "digest"), blocks))
        rows = rows.join(hits, ["digest", "salt"], "left")
        return rows.select(restore_id().alias("id"), F.coalesce("spans", F.array().cast(_SPANS[6:])).alias("spans"))
    index = _index(docs.sparkSession, blocks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), _spans(index.value.search(batch.column("text").to_pylist()))], names=["id", "spans"])

    return rows.mapInArrow(run, f"id long, {_SPANS}").withColumn("id", restore_id())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, all columns, in which no benchmark pattern is found; null texts, missing and repeated ids stay."""
    blocks = _blocks(benchmark, item_col, item_text)
    if len(blocks) > 1:
        out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), text_digest(text_col).alias("digest"))
        out, hits = _salted(out, _hits(out.select("text", "digest"), blocks).select("digest"))
        return out.join(hits, ["digest", "salt"], "left_anti").select("doc.*")
    index = _index(docs.sparkSession, blocks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array([not x for x in index.value.search([t or "" for t in batch.column(text_col).to_pylist()])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
