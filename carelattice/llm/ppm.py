"""Language-model scoring by prediction by partial matching (PPM) over bytes.

Training counts, over all training rows, every word and every run of ORDER + 1 bytes. The runs make a context trie of
depth ORDER: with t occurrences of d distinct symbols, a node escapes with probability d / 2t, and a symbol seen c times
has (2c - 1) / 2t (method D). A symbol that a longer context knows is excluded from the shorter one after an escape. As the symbols of a context are among those of
its suffix, exclusion and escape together are one factor for each context, so that the probability of a byte is that of
the longest context which knows it times the factors of the longer ones: table look-ups, done for whole slices of text
with numpy.

Every node is kept. Contexts of three bytes and more are dealt by their last three bytes, so that a part of the trie
holds all that its probabilities depend on (with the contexts of up to two bytes, which every part gets). There are as
many parts as the input is large, up to one for each three bytes; beyond TASKS a task takes several in turn. A part's
runs are distinct, so it can't outgrow 256 ** 3 of them; its places can, so they come after its runs and are answered
PLACES at a time, and a part that is asked for more than LOAD places is given to several tasks, each with all its runs
and a share of its places. What is broadcast has a fixed capacity and only saves look-ups: the probabilities, from the whole trie, of the NODES most
frequent runs, and HEAD words. Places with other runs go to the part of the trie that knows them, packed for many
documents at once, and come back as sums; other words are joined with the whole table of counts. So neither score
depends on these sizes.

A text is scored as its words, lower-cased, each followed by a space or, the last, by the end symbol.

Defined results: null text has no words and one end; a row without id counts as having the id ''; repeated rows count and
score as often as they occur; without training rows every byte has probability 1/256.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, hash_words, id_and_text, held_out, mix, partitions_for, restore_id, slices

ORDER = 5
NODES = 1_600_000
HEAD = 1_000_000
#: Contexts of fewer bytes than this are given to every part of the trie.
TOP = 3
#: Places (or runs) that a task gathers before it sends them to the parts of the trie.
PLACES = 1 << 20
#: Places for which one task answers; parts with more are given to several tasks.
LOAD = 1 << 25
#: Most tasks of a shuffle.
TASKS = 100_000
#: Leading bits of a count that tell how often it occurs, so that what is collected of counts stays small.
BITS = 10
#: Bytes of text that are counted or scored at once: a dozen arrays of eight bytes for each.
SLICE = 1 << 18
HELD_OUT = (7, 2)
END = 10  # no word holds a newline


class Table:
    """Values of distinct uint64 keys: sorted by a mixed hash, with an index on its upper bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = mix(keys.astype(np.uint64))
        order = np.argsort(h)
        self.keys, self.values = h[order], values[order]
        self.bits = max(1, int(len(keys)).bit_length())
        self.start = np.searchsorted(self.keys, np.arange((1 << self.bits) + 1, dtype=np.float64) * 2.0 ** (64 - self.bits)).astype(np.int32) if len(keys) else np.zeros((1 << self.bits) + 1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        h = mix(keys)
        b = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.start[b].astype(np.int64), self.start[b + 1]
        left = np.flatnonzero(at < stop)
        while len(left):
            i = at[left]
            same = self.keys[i] == h[left]
            out[left[same]] = i[same]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out


class Model(NamedTuple):
    order: int
    symbols: list[Table]  # by order: log10 probability of context and symbol
    contexts: list[Table]  # by order: log10 factor of a context that doesn't know the symbol
    unseen: float  # log10 probability of a symbol that no context knows


def text_bytes(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind `order` end symbols each, and which places are text."""
    pad = bytes([END]) * order
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    real = np.ones(len(data), bool)
    starts = np.concatenate([[0], np.cumsum([len(t) + order for t in texts])[:-1]]).astype(np.int64)
    real[(starts[:, None] + np.arange(order)).ravel()] = False
    return data, real


def grams(data: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """The order + 1 bytes that end at each place, oldest first, as a number."""
    code = np.zeros(len(data), np.uint64)
    for j in range(order, -1, -1):
        code[j:] |= data[: len(data) - j].astype(np.uint64) << np.uint64(8 * j) if j else data.astype(np.uint64)
    return code[places]


def _merge(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
    return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, docs = 0, 0

        def batch_of(w: list, g: np.ndarray, n) -> pa.RecordBatch:
            m = len(w) + len(g)
            return pa.RecordBatch.from_arrays([pa.array(w + [None] * len(g), pa.binary()), pa.array(np.concatenate([np.zeros(len(w), np.int64), g.view(np.int64)])), pa.array(n, pa.int64())], names=["word", "gram", "n"]) if m else None

        def flush_words() -> Iterator[pa.RecordBatch]:
            keys = list(words)
            for i in range(0, len(keys), 100_000):
                part = keys[i : i + 100_000]
                yield batch_of(part, np.empty(0, np.uint64), [words[k] for k in part])
            words.clear()

        def flush_grams() -> Iterator[pa.RecordBatch]:
            codes, counts = _merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            for i in range(0, len(codes), 100_000):
                yield batch_of([], codes[i : i + 100_000], counts[i : i + 100_000])
            held.clear()

        for batch in slices(batches, most=SLICE):
            texts = []
            for text in batch.column("text").to_pylist():
                own = text.encode("utf-8", "surrogatepass").lower().split()
                words.update(own)
                texts.append(text_bytes(own))
                docs += 1
            data, real = stream(texts, order)
            codes = np.sort(grams(data, np.flatnonzero(real), order))
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            held.append((codes[starts], np.diff(np.append(starts, len(codes)))))
            size += len(starts)
            if len(held) >= 16:
                held[:] = [_merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
                size = len(held[0][0])
                if size > 600_000:
                    yield from flush_grams()
                    size = 0
            if len(words) > 120_000:
                yield from flush_words()
        if docs:
            words[b"\n"] += docs
            yield from flush_words()
            if held:
                yield from flush_grams()

    return run


def train(codes: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """The model of the trie whose nodes of each order are given: codes (context and symbol) and their counts."""
    symbols, contexts = [], []
    below: tuple | None = None
    unseen = -math.log10(256)
    for j, (code, c) in enumerate(zip(codes, counts, strict=True)):
        order = np.argsort(code)
        code, c = code[order].astype(np.uint64), c[order].astype(float)
        ctx = code >> np.uint64(8)
        starts = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.empty(0, int)
        d = np.diff(np.append(starts, len(ctx))).astype(float)
        total = np.add.reduceat(c, starts) if len(ctx) else c
        weight = 2 * c - 1
        symbols.append(Table(code, np.log10(weight / np.repeat(2 * total, d.astype(int))).astype(np.float32)))
        own = ctx[starts]
        factor = d / (2 * total)
        if j == 0:
            if len(d):
                unseen = math.log10(factor[0] / (256 - d[0])) if d[0] < 256 else -math.log10(256)
            contexts.append(Table(np.empty(0, np.uint64), np.empty(0)))
        else:
            low_code, low_weight, low_ctx, low_total = below
            mask = np.uint64((1 << (8 * j)) - 1)
            excluded = np.add.reduceat(low_weight[np.searchsorted(low_code, code & mask)], starts) if len(ctx) else c
            at = np.searchsorted(low_ctx, own & np.uint64((1 << (8 * (j - 1))) - 1))
            factor = factor * 2 * low_total[at] / (2 * low_total[at] - excluded)
            contexts.append(Table(own, np.log10(factor).astype(np.float32)))
        below = (code, weight, own, total)
    return Model(len(codes) - 1, symbols, contexts, unseen)


def log_probabilities(model: Model, data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """log10 probability of the bytes at these places, each given the `order` bytes before it."""
    return log_of(model, grams(data, places, model.order))


def log_of(model: Model, code: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each run, given the bytes before it."""
    out = np.zeros(len(code))
    left = np.arange(len(code))
    for j in range(model.order, -1, -1):
        mine = code[left] & np.uint64((1 << (8 * (j + 1))) - 1)
        at = model.symbols[j].find(mine)
        hit = at >= 0
        out[left[hit]] += model.symbols[j].values[at[hit]]
        left, mine = left[~hit], mine[~hit]
        if not len(left):
            return out
        if j:
            at = model.contexts[j].find(mine >> np.uint64(8))
            known = at >= 0
            out[left[known]] += model.contexts[j].values[at[known]]
    out[left] += model.unseen
    return out


def _threshold(sizes: DataFrame, most: int) -> int:
    """A count n such that at most `most` rows have n or more: the least one, of its leading BITS. sizes: n, rows."""
    total, least = 0, 1 << 62
    shift = F.greatest(F.length(F.bin("n")) - BITS, F.lit(0))
    leading = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), shift), shift)
    for n, rows in sorted(((r.n, r.rows) for r in sizes.groupBy(leading.alias("n")).agg(F.sum("rows").alias("rows")).collect()), reverse=True):
        total += rows
        if total > most:
            break
        least = n
    return least


def _part(code: np.ndarray, parts: int) -> np.ndarray:
    """The part of the trie that a run belongs to: by the last TOP bytes of its context."""
    context = (code >> np.uint64(8)) & np.uint64((1 << (8 * TOP)) - 1)
    return ((mix(context + np.uint64(1)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _dealt(code: np.ndarray, parts: int, *others: np.ndarray) -> Iterator[tuple]:
    """part, runs and what belongs to them, in order, for each part that has any."""
    part = _part(code, parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[i] : edges[i + 1]]
        yield i, code[at], *(x[at] for x in others)


def _part_model(top: list[tuple[np.ndarray, np.ndarray]], code: np.ndarray, count: np.ndarray, order: int) -> Model:
    """The model of a part: all of its runs of order + 1 bytes, and the complete low orders."""
    levels = [*top]
    for j in range(len(top), order + 1):
        levels.append(_merge(code & np.uint64((1 << (8 * (j + 1))) - 1), count))
    return train([c for c, _ in levels], [n for _, n in levels])


#: Rows on their way to the parts of the trie: documents; runs with their counts; places with their documents' uids.
_KINDS = {
    "task": pa.int32(), "part": pa.int32(), "uid": pa.int64(), "id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
    "logs": pa.float64(), "score": pa.float64(), "rare": pa.list_(pa.binary()), "asked": pa.bool_(), "codes": pa.binary(), "numbers": pa.binary(),
}
_ROWS = "task int, part int, uid long, id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<binary>, asked boolean, codes binary, numbers binary"


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in _KINDS.items()], names=list(_KINDS))


class Deal(NamedTuple):
    """How many parts the trie has, how many tasks they go to, and the parts that several tasks get, with their number."""

    parts: int
    tasks: int
    copies: dict[int, int] = {}

    def send(self, held: list[tuple[np.ndarray, np.ndarray]], asked: bool, turn: int = 0) -> Iterator[pa.RecordBatch]:
        """What is held, as one row for each part: runs go to all tasks of their part, places to one, by turns."""
        dealt = list(_dealt(np.concatenate([h[0] for h in held]), self.parts, np.concatenate([h[1] for h in held])))
        held.clear()
        for copy in range(1 if asked else max(self.copies.values(), default=1)):
            own = [x for x in dealt if copy < self.copies.get(x[0], 1)]
            tasks = [(x[0] + (turn % self.copies.get(x[0], 1) if asked else copy)) % self.tasks for x in own]
            yield _rows(task=tasks, part=[x[0] for x in own], asked=[asked] * len(own), codes=[x[1].tobytes() for x in own], numbers=[x[2].tobytes() for x in own])

    def pack(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs and counts by part."""
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("gram").to_numpy().view(np.uint64), batch.column("n").to_numpy()))
                size += batch.num_rows
            if size >= PLACES:
                yield from self.send(held, False)
                size = 0
        if held:
            yield from self.send(held, False)

    def meet(self, rows: DataFrame) -> DataFrame:
        """The rows by task; in it by part: documents, then the part's runs, then its places."""
        return rows.repartitionById(self.tasks, "task").sortWithinPartitions("part", "asked")


def _met(batches: Iterator[pa.RecordBatch], documents: list[pa.RecordBatch] | None = None) -> Iterator[tuple]:
    """part, asked, codes and numbers: a part's runs and their counts at once, places and their documents' uids PLACES at a time.

    Other rows are added to documents; after each batch an empty tuple follows.
    """
    held: list[tuple[bytes, bytes]] = []
    at, size = (0, False), 0

    def done() -> tuple:
        codes, numbers = (b"".join(x) for x in zip(*held, strict=True))
        held.clear()
        return *at, np.frombuffer(codes, np.uint64), np.frombuffer(numbers, np.int64)

    for batch in batches:
        packed = pc.is_valid(batch.column("codes"))
        if documents is not None:
            documents.append(batch.filter(pc.invert(packed)))
        yield ()
        batch = batch.filter(packed)
        for part, asked, codes, numbers in zip(*(batch.column(c) for c in ("part", "asked", "codes", "numbers")), strict=True):
            here = (part.as_py(), asked.as_py())
            if held and (here != at or here[1] and size >= PLACES):
                yield done()
                size = 0
            at = here
            held.append((codes.as_py(), numbers.as_py()))
            size += len(held[-1][0]) // 8
    if held:
        yield done()


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, nodes: int = NODES, head: int = HEAD, load: int = LOAD) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    train_rows = id_and_text(docs.filter(~held_out(id_col, *HELD_OUT)), id_col, text_col)
    parts = min(partitions_for(rows, most=1 << 31), 1 << (8 * TOP))
    deal = Deal(parts, min(parts, TASKS))
    counts = checkpoint(train_rows.select("text").mapInArrow(_count(order), "word binary, gram long, n long").groupBy("word", "gram").agg(F.sum("n").alias("n")))
    words = counts.filter("word is not null").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = math.log10(total + distinct + 1)

    # the low orders of the trie, whole
    runs = counts.filter("word is null").select("gram", "n")
    levels = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("gram").bitwiseAND((1 << (8 * (j + 1))) - 1).alias("code")) for j in range(min(TOP, order + 1))])).alias("x")
    low = runs.select(levels, "n").select("x.*", "n").groupBy("j", "code").agg(F.sum("n").alias("n")).toArrow()
    j, code, n = (low.column(c).to_numpy() for c in ("j", "code", "n"))
    complete = spark.sparkContext.broadcast([(code[j == i].view(np.uint64), n[j == i]) for i in range(min(TOP, order + 1))])
    del low, j, code, n

    # the runs that most places are, and the parts that the other places would ask too often for one task
    least = _threshold(runs.groupBy("n").agg(F.count("*").alias("rows")), nodes)

    def frequent_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in _met(batches):
            if not met:
                continue
            part, _, code, count = met
            rest = int(count[count < least].sum())
            if rest > load:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.nulls(1, pa.float64()), pa.array([-(-rest // load)], pa.int64())], names=["code", "value", "copies"])
            some = code[count >= least]
            if len(some):
                values = log_of(_part_model(complete.value, code, count, order), some)
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(values), pa.nulls(len(some), pa.int64())], names=["code", "value", "copies"])

    cached = deal.meet(runs.mapInArrow(deal.pack, _ROWS)).mapInArrow(frequent_runs, "code long, value double, copies long").toArrow()
    several = cached.filter(pc.is_valid(cached.column("copies")))
    deal = deal._replace(copies={p: min(n, deal.tasks) for p, n in zip(several.column("code").to_pylist(), several.column("copies").to_pylist(), strict=True)})
    cached = cached.filter(pc.is_valid(cached.column("value")))

    # the words that most tokens are
    limit = _threshold(words.groupBy("n").agg(F.count("*").alias("rows")), head)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hash_words(b.column("word").to_pylist()).view(np.int64)), b.column("n")], names=["h", "n"])

    top = words.filter(F.col("n") >= limit).mapInArrow(hashed, "h long, n long").toArrow()
    shared = spark.sparkContext.broadcast((Table(cached.column("code").to_numpy().view(np.uint64), cached.column("value").to_numpy()), Table(*_logs(top))))
    del top, cached

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequent = shared.value
        turn = TaskContext.get().partitionId()
        uid = turn << 33
        held, size = [], 0
        for batch in slices(batches, most=SLICE):
            texts, own, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                w = text.encode("utf-8", "surrogatepass").lower().split()
                texts.append(text_bytes(w))
                own += w
                own.append(b"\n")
                sizes.append(len(w) + 1)
            at = frequent.find(hash_words(own))
            ends = np.cumsum(sizes)
            logs = np.where(at >= 0, frequent.values[np.maximum(at, 0)] if len(frequent.values) else 0.0, 0.0)
            # words beyond the broadcast ones; those are joined below
            rare = [[own[i] for i in (np.flatnonzero(at[b - s : b] < 0) + b - s).tolist()] for s, b in zip(sizes, ends.tolist(), strict=True)]
            data, real = stream(texts, order)
            code = grams(data, np.flatnonzero(real), order)
            m, lengths = len(texts), np.array([len(t) for t in texts])
            at = known.find(code)
            p = np.add.reduceat(np.where(at >= 0, known.values[np.maximum(at, 0)] if len(known.values) else 0.0, 0.0), np.cumsum(lengths) - lengths)
            # places beyond the broadcast ones; their part of the trie is asked
            left = np.flatnonzero(at < 0)
            if len(left):
                held.append((code[left], np.repeat(np.arange(uid, uid + m), lengths)[left]))
                size += len(left)
            if size >= PLACES:
                yield from deal.send(held, True, turn)
                size, turn = 0, turn + 1
            yield _rows(
                task=np.arange(uid, uid + m) % deal.tasks, part=np.zeros(m, np.int32), uid=np.arange(uid, uid + m), id=batch.column("id"), held_out=batch.column("held"), n_tokens=sizes,
                n_known=[s - len(r) for s, r in zip(sizes, rare, strict=True)], logs=np.add.reduceat(logs, ends - sizes).astype(float), score=p, rare=rare,
            )
            uid += m
        if held:
            yield from deal.send(held, True, turn)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents: list[pa.RecordBatch] = []
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        own, runs_of, model = -1, none, None
        for met in _met(batches, documents):
            while documents:
                yield documents.pop()
            if not met:
                continue
            part, asked, code, number = met
            if part != own:
                own, runs_of, model = part, none, None
            if not asked:
                runs_of = code, number
                continue
            if model is None:
                model = _part_model(complete.value, *runs_of, order)
            codes, back = np.unique(code, return_inverse=True)
            uids, at = np.unique(number, return_inverse=True)
            yield _rows(uid=uids, score=np.bincount(at, log_of(model, codes)[back]), asked=np.ones(len(uids), bool))

    rows = rows.withColumn("held", held_out(F.when(F.col("id") != (1 << 63) - 1, F.col("id")), *HELD_OUT))
    sent = rows.mapInArrow(look, _ROWS).unionByName(runs.mapInArrow(deal.pack, _ROWS))
    seen = checkpoint(deal.meet(sent).mapInArrow(ask, _ROWS).drop("task", "part", "codes", "numbers"))
    answers = seen.filter("asked").select("uid", F.lit(0).cast("long").alias("times"), F.lit(0.0).alias("word_logs"), F.col("score").alias("more_score"))
    seen = seen.filter("asked is null").drop("asked")
    found = seen.select("uid", F.explode("rare").alias("word")).groupBy("uid", "word").agg(F.count("*").alias("times")).join(words, "word")
    found = found.select("uid", "times", (F.col("times") * F.log10(F.col("n") + 1)).alias("word_logs"), F.lit(0.0).alias("more_score")).unionByName(answers)
    found = found.groupBy("uid").agg(F.sum("times").alias("more"), F.sum("word_logs").alias("more_logs"), F.sum("more_score").alias("more_score"))
    out = seen.drop("rare").join(found, "uid", "left").fillna(0, ["more", "more_logs", "more_score"])
    return out.select(
        restore_id().alias("id"), "held_out", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * F.lit(base)).alias("base_score"), (F.col("score") + F.col("more_score")).alias("score"),
    )


def _logs(top: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    h, i = np.unique(top.column("h").to_numpy().view(np.uint64), return_index=True)
    return h, np.log10(top.column("n").to_numpy()[i] + 1.0)
