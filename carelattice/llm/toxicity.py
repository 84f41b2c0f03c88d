"""Toxicity by maximum-scoring segments.

Features are a token and its prefixes of 4 to 6 characters. From labelled documents each feature gets a log-odds with a
Dirichlet prior over the documents of either class that hold it; a token scores its best feature's log-odds, less a
shift that makes the expected score of clean text negative. A linear-time scan then finds all maximal-scoring segments
of a document. Their scores are judged by extreme-value statistics: lambda solves E[exp(lambda s)] = 1 over the tokens
of clean documents, K follows from the clean documents' best scores, and S' = lambda S - ln(K n) makes segments of
documents of any length comparable. A logistic curve over the best S' and the number of significant segments turns
them into a probability.

Labels are learned from at most MAX_LABELS rows (by a hash of their ids), two thirds of them for the log-odds and the
rest, unseen by these, for the calibration. Everything else covers all rows and whole texts.

Defined results: null and empty texts score what the curve gives to no evidence; without any labelled toxic row the
score is 0. Repeated label rows count as toxic if one of them does; rows without an id or a label are not learned from. Of documents
that share an id one is learned from (the last by its text).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, held_out, id_and_text, restore_id, slices
from .licenses import words_of

#: Bound of the labelled sample; its ids (16 bytes each) are broadcast.
MAX_LABELS = 30_000
PRIOR, SHIFT, GAP, MIN_DOCS = 2.0, 2.0, 0.25, 3
PREFIXES = (4, 5, 6)
SIGNIFICANT = 0.01
HELD_OUT = (5, 0)


class Model(NamedTuple):
    weights: dict[bytes, float]
    lam: float
    k: float
    curve: tuple[float, float, float]


def features(word: bytes) -> list[bytes]:
    text = word.decode("utf-8", "replace")
    return [word, *(f"{text[:n]}*".encode() for n in PREFIXES if len(text) >= n)]


class Scores(dict):
    """Token scores, remembered up to a bounded number of tokens."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 400_000:
            self.clear()
        best = max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)
        value = self[word] = best - SHIFT if best > SHIFT else -GAP
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, stop, score), in one scan over the positive tokens."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []  # start, stop, sum before, sum after
    back: list[int] = []  # of each segment, the last one before it with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, stop, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = back[j]
            if j < 0 or found[j][3] >= right:
                found.append((start, stop, left, right))
                back.append(j)
                break
            start, left = found[j][0], found[j][2]
            del found[j:], back[j:]
    return [(a, b, r - l) for a, b, l, r in found]


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col, *HELD_OUT))
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(F.col(label_col).cast("int")) > 0).cast("int").alias("label"))
    share = min(1.0, MAX_LABELS / max(1, rows.count()))
    h = F.pmod(F.xxhash64("id"), F.lit(3_000_000))
    return rows.filter(h < int(3_000_000 * share)).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)).cast("int"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple[Counter, Counter] = (Counter(), Counter())
    docs = [0, 0]

    def flush() -> pa.RecordBatch:
        keys = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in held)], names=["feature", "n0", "n1"])
        for c in held:
            c.clear()
        return out

    for batch in slices(batches):
        for y, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            docs[y] += 1
            held[y].update({f for w in set(words_of(text)) for f in features(w)})
        if len(held[0]) + len(held[1]) > 500_000:
            yield flush()
    held[0][b""], held[1][b""] = docs  # the empty feature counts documents
    yield flush()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    sample = _sample(docs, labels, id_col, label_col)
    # at most about MAX_LABELS rows, however often an id repeats: the sample's ids are broadcast, its texts written once
    rows = checkpoint(id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").groupBy("id", "label", "fold").agg(F.max("text").alias("text")).select("label", "fold", "text"))
    counts = rows.filter("fold > 0").select("label", "text").mapInArrow(_counts, "feature binary, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = checkpoint(counts.filter(f"n1 >= {MIN_DOCS} or feature = X''"))
    totals = next(((r.n0, r.n1) for r in counts.filter("feature = X''").collect()), (0, 0))
    if not totals[1] or not totals[0]:
        return None
    per0, per1 = (sum(totals) / (2 * t) for t in totals)
    odds = F.log((F.col("n1") * per1 + PRIOR) / (F.col("n0") * per0 + PRIOR))
    weights = {bytes(r.feature): r.odds for r in counts.filter("feature <> X''").select("feature", odds.alias("odds")).filter(F.col("odds") > SHIFT).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        known = Scores(shared.value)
        for y, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            yield y, np.fromiter(map(known.__getitem__, words_of(text)), float)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(len(s), max((x[2] for x in segments(s)), default=0.0), np.bincount(np.minimum(s[s > 0] * 4, 63).astype(int), minlength=64).tolist()) for y, s in scored(batch) if y == 0 and len(s)]
            columns = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.float64(), pa.list_(pa.int64())), strict=True)], names=["n", "best", "up"])

    calibration = rows.filter("fold = 0").select("label", "text")
    clean = calibration.mapInArrow(look, "n long, best double, up array<long>").collect()
    up = np.sum([r.up for r in clean], axis=0, dtype=float) if clean else np.zeros(64)
    lam = _lambda(up / max(1, sum(r.n for r in clean)))
    best = [lam * r.best - math.log(r.n) for r in clean]
    k = math.exp(np.mean(best) - 0.5772) if best else 1.0

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(float(y), *evidence([x[2] for x in segments(s)], len(s), lam, k)) for y, s in scored(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in (zip(*out, strict=True) if out else ([], [], []))], names=["y", "best", "significant"])

    # the same evidence, of all segments, that documents are scored by
    seen = np.array([(r.y, r.best, r.significant) for r in calibration.mapInArrow(judge, "y double, best double, significant double").collect()]).reshape(-1, 3)
    return Model(weights, lam, k, _logistic(seen[:, 1:], seen[:, 0]))


def _lambda(share: np.ndarray) -> float:
    """The root of E[exp(lambda s)] = 1; share: of the tokens, by positive score in quarters."""
    s = (np.arange(64) + 0.5) / 4
    excess = lambda x: float((share * np.exp(x * s)).sum() + (1 - share.sum()) * math.exp(-x * GAP) - 1)
    low, high = 0.01, 3.0
    if excess(high) < 0:
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 0.05)


def evidence(found: list[float], n: int, lam: float, k: float) -> tuple[float, float]:
    """The best normalised score, and how many segments are significant, both on a logarithmic scale."""
    shift = math.log(max(k * max(n, 1), 1e-9))
    best = lam * max(found, default=0.0) - shift
    significant = sum(-math.expm1(-math.exp(min(shift - lam * s, 50.0))) < SIGNIFICANT for s in found)
    return math.copysign(math.log1p(abs(best)), best), math.log1p(significant)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(3)
        w += np.clip(np.linalg.solve(h, a.T @ (y - p) - 0.05 * w), -5, 5)
    return tuple(float(v) for v in w)


def probability(model: Model, found: list[float], n: int) -> float:
    z, count = evidence(found, n, model.lam, model.k)
    a, b, c = model.curve
    return 1 / (1 + math.exp(-min(max(a + b * z + c * count, -30.0), 30.0)))


def score_batches(model: Model | None, batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[float], list[list[tuple[int, int, float]]]]]:
    """Each slice with its rows' probabilities and their significant segments."""
    known = Scores(model.weights) if model else None
    for batch in slices(batches, text):
        scores, spans = [], []
        for value in batch.column(text).to_pylist():
            s = np.fromiter(map(known.__getitem__, words_of(value or "")), float) if model else np.empty(0)
            found = segments(s)
            scores.append(probability(model, [x[2] for x in found], len(s)) if model else 0.0)
            spans.append([x for x in found if model.lam * x[2] - math.log(max(model.k * len(s), 1e-9)) > -math.log(SIGNIFICANT)] if found else [])
        yield batch, scores, spans


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id, score, passages (significant segments: first word, word after the last, score) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores, spans in score_batches(model.value, batches):
            kind = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores), pa.array([[dict(zip(("first", "stop", "score"), x, strict=True)) for x in y] for y in spans], kind)], names=["id", "score", "passages"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "id long, score double, passages array<struct<first:int,stop:int,score:double>>").withColumn("id", restore_id())


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score below limit; one pass, no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores, _ in score_batches(model.value, batches, text_col):
            yield batch.filter(pa.array([s < limit for s in scores]))

    return docs.mapInArrow(run, docs.schema)
