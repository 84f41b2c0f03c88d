"""Substring deduplication by Rabin-Karp window hashes.

Every window of `window` words is hashed and counted across documents (shared_keys: one winner for each hash and chunk
is shuffled). A document removes each word that lies in a window which a document with a smaller id also has; the
windows are judged on the input, and touching or overlapping ones merge into maximal removal intervals.

Only documents that may have something to remove (a fixed-size filter on their ids tells) carry their text through the
join with the answers.

Defined results: null text has no words; a document shorter than a window loses nothing; documents with equal ids count
as one for "smaller" and each loses its own words; rows without an id rank after all others, one after another as they are
read, so the first of them keeps what they have in common. Ids have to be less than 2^62.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import checkpoint, filter_position, hash_words, id_filter, may_contain, own_ids, restore_own, rolling, slices, split_words
from .shared_keys import LOW, shared_keys, unpack7

WINDOW = 13


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [first, stop) covered by windows at these sorted starts."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > window) + 1
    return list(zip(starts[np.concatenate([[0], cuts])].tolist(), (starts[np.concatenate([cuts - 1, [len(starts) - 1]])] + window).tolist(), strict=True))


def without(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    return kept + words[at:]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, spans (first word, word after the last), kept_sha256, and with with_text the kept text."""
    rows = own_ids(docs, id_col, text_col)
    found = checkpoint(shared_keys(rows, lambda text: rolling(hash_words(split_words(text)), window), earlier=True))
    told = id_filter(found)
    bits, size = docs.sparkSession.sparkContext.broadcast(told), 8 * len(told)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits.value, np.uint8)
        for batch in slices(batches):
            sizes, digests, texts = [], [], []
            for text, maybe in zip(batch.column("text").to_pylist(), may_contain(known, batch.column("at").to_numpy()).tolist(), strict=True):
                words = split_words(text)
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                texts.append(text if maybe or with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(texts, pa.string())], names=["id", "n_words", "digest", "text"])

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for text, digest, told in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist(), batch.column("told").to_pylist(), strict=True):
                spans, kept = [], None
                if told and text is not None:
                    words = split_words(text)
                    hit = np.isin(rolling(hash_words(words), window) & LOW, unpack7(told))
                    spans = intervals(np.flatnonzero(hit), window)
                    kept = b" ".join(without(words, spans))
                    digest = hashlib.sha256(kept).digest()
                elif with_text:
                    kept = b" ".join(split_words(text))
                for column, value in zip(out, (sum(b - a for a, b in spans), [{"first": a, "stop": b} for a, b in spans], digest.hex(), kept.decode("utf-8", "surrogatepass") if with_text else None), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), pa.array(out[0], pa.int64()), pa.array(out[1], kind), pa.array(out[2]), *([pa.array(out[3], pa.string())] if with_text else [])],
                names=["id", "n_words", "n_removed", "spans", "kept_sha256", *(["text"] if with_text else [])],
            )

    read = rows.withColumn("at", filter_position(size)).mapInArrow(first, "id long, n_words long, digest binary, text string")
    schema = "id long, n_words long, n_removed long, spans array<struct<first:int,stop:int>>, kept_sha256 string" + ", text string" * with_text
    return read.join(found.withColumnRenamed("keys", "told"), "id", "left").mapInArrow(last, schema).withColumn("id", restore_own())
