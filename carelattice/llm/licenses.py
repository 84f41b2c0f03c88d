"""License scan by diagonal voting.

Words are runs of letters, digits and characters beyond ASCII, in lower case. Every rolling word pair of every document
is hashed and joined in Spark with the pairs of the templates (a fixed table, so it is broadcast). A match votes for
the diagonal (its place in the document minus its place in the template). Base phrases are found where one diagonal has
all their pairs; for the longer notices, diagonals at most SHIFT apart are merged (a word added or lost moves the rest by
one), and a merged span is verified by the share of the template's pairs that it holds. Short phrases have to match
whole on one diagonal; spans that a chain of diagonals makes longer than a notice can be are judged diagonal by diagonal.

Defined results: null and empty texts, and texts without words, have no spans. Rows with equal ids are scanned each for
itself. A hot document only has as many votes as words times the template places of a pair, which the table bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_words, id_and_text, restore_id, rolling, slices

K = 2
SHIFT = 3
SIMILARITY = 0.6
#: Templates of fewer pairs have to match whole.
SHORT = 6
#: Rows that a worker sends at once, and bytes of text that it takes at once (a longer text is taken whole).
BATCH, SLICE = 10_000, 1 << 18
#: The pair hash of the row that stands for a whole document.
WHOLE = -1

# Phrases whose places count as base, with their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Openings of public licence notices, with their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("you should have received a copy of the gnu general public license along with this program", "gpl"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc0 1 0 universal public domain dedication", "cc0"),
    ("all rights reserved", "all-rights-reserved"),
)

#: A to Z to lower case; what stands between words to spaces.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def templates() -> list[tuple[int, int, int, int, bool, str]]:
    """hash, template, place, pairs, base, label of every template pair, and the row for whole documents."""
    rows = [(WHOLE, -1, 0, 0, False, "")]
    for number, (phrase, label) in enumerate(BASE + NOTICES):
        pairs = rolling(hash_words(words_of(phrase)), K).view(np.int64).tolist()
        rows += [(h, number, i, len(pairs), number < len(BASE), label) for i, h in enumerate(pairs)]
    return rows


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each word pair of each text, and one that stands for the whole text; BATCH rows at once."""
    n = TaskContext.get().partitionId() << 33
    for batch in slices(batches, most=SLICE):
        for one, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            n += 1
            own = words_of(text)
            hashes = np.append(rolling(hash_words(own), K).view(np.int64), WHOLE)
            at = np.append(np.arange(len(hashes) - 1, dtype=np.int32), np.int32(len(own)))
            for i in range(0, len(hashes), BATCH):
                m = len(hashes[i : i + BATCH])
                yield n, np.full(m, one), at[i : i + BATCH], hashes[i : i + BATCH]


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts that _pairs makes, several short texts to a batch."""
    held, size = [], 0

    def send() -> pa.RecordBatch:
        rows = np.repeat([x[0] for x in held], [len(x[1]) for x in held])
        return pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(np.concatenate([x[i] for x in held])) for i in (1, 2, 3))], names=["row", "id", "at", "hash"])

    for part in _pairs(batches):
        held.append(part)
        size += len(part[1])
        if size >= BATCH:
            yield send()
            held, size = [], 0
    if held:
        yield send()


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans with row, id, template (-1: the row for the whole document, whose `words` is its length), label, base, first, words, similarity."""
    spark = docs.sparkSession
    known = spark.createDataFrame(templates(), "hash long, template int, place int, pairs int, base boolean, label string")
    hits = id_and_text(docs, id_col, text_col).mapInArrow(_batched, "row long, id long, at int, hash long").join(F.broadcast(known), "hash")
    # a diagonal's places are bits of one number, so that hits combine before they are shuffled
    of = ["row", "id", "template", "label", "base", "pairs"]
    votes = hits.groupBy(*of, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))).alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    # one plan for all kinds of rows: split branches would each read and hash the texts again
    short = F.col("base") | (F.col("pairs") < SHORT)  # such a phrase has to match whole, on one diagonal
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    before = F.lag("diagonal").over(order)
    apart = short | (F.col("template") < 0) | before.isNull() | (F.col("diagonal") - before > SHIFT)
    votes = votes.repartition("row").withColumn("starts", apart.cast("int")).withColumn("cluster", F.sum("starts").over(order))
    # a chain longer than a notice can be is judged diagonal by diagonal, each with those up to SHIFT above it
    longest, chain, near = 2 * F.col("pairs") + SHIFT, Window.partitionBy("row", "template", "cluster"), order.rangeBetween(0, SHIFT)
    merged = lambda w: (F.bit_or("places").over(w), F.min("first").over(w), F.max("last").over(w))
    whole, some = merged(chain), merged(near)
    fits = short | (whole[2] - whole[1] <= longest)
    votes = votes.select(*of, "diagonal", "cluster", fits.alias("fits"), F.struct(*(x.alias(c) for x, c in zip(whole, ("places", "first", "last"), strict=True))).alias("whole"), F.struct(*(x.alias(c) for x, c in zip(some, ("places", "first", "last"), strict=True))).alias("some"))
    votes = votes.withColumn("at", F.when(F.col("fits"), F.col("whole")).otherwise(F.col("some"))).dropDuplicates(["row", "template", "cluster", "at"])
    similarity = F.when(F.col("template") >= 0, F.bit_count("at.places") / F.col("pairs")).otherwise(0.0)
    least = F.when(short, 1.0).otherwise(SIMILARITY)
    span = F.col("at.last") - F.col("at.first")
    verified = (F.col("template") < 0) | (similarity >= least) & (span <= longest)
    return votes.filter(verified).select(
        "row", restore_id().alias("id"), "template", "label", "base", F.col("at.first").alias("first"), F.when(F.col("template") < 0, F.col("diagonal")).otherwise(span + K).alias("words"), similarity.alias("similarity")
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spans = license_spans(docs, id_col, text_col)
    joined = lambda when: F.array_join(F.sort_array(F.collect_set(F.when(when, F.col("label")))), ",")
    return spans.groupBy("row").agg(
        F.first("id").alias("id"),
        F.max(F.when(F.col("template") == -1, F.col("words").cast("long"))).alias("n_words"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first").cast("long"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first").cast("long"))).alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.col("template") >= 0).alias("labels"),
        F.max("similarity").alias("score"),
    ).drop("row")
