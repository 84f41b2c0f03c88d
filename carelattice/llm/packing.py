"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokens are made in one pass over the texts. What has to be placed - a few numbers for each piece - is all that is
shuffled; each pack task then runs bounded-space online best fit: OPEN bins at most, held in a bitset keyed by free
space. A piece goes to the fullest open bin that still takes it (the lowest set bit from its length upwards); if none
does, a bin is opened, and if that makes too many, the fullest closes first. Pieces arrive in runs, each from long to
short, and the open bins carry over from run to run, so a task's waste doesn't grow with the number of its runs.

Defined results: null text is empty, and an empty text is one piece of its end token alone. Rows with equal ids are
packed each for itself. Only documents longer than a sequence are cut, their first piece being the short one.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, id_and_text, restore_id, slices

LENGTH = 1024
END = 2
#: Bins that a task keeps open, and pieces in a run.
OPEN, RUN = 8192, 16384
#: Pieces for each pack task: few enough for one task, enough that its last open bins don't matter.
PIECES = 200_000
#: Chunks of text whose tokens a worker remembers.
REMEMBERED = 300_000


class Tokens(dict):
    """Token ids, as little-endian uint32 bytes, of chunks that end before a space."""

    #: A space before white space: only there may a cut at spaces change the tokens.
    ODD = re.compile(r" (?=\s)")
    CUT = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.added = {k: np.asarray([v], "<u4").tobytes() for k, v in added.items()}
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})") if added else None

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        value = np.asarray(self.encoding.encode_ordinary(chunk), "<u4").tobytes()
        if len(chunk) < 64:
            self[chunk] = value
        return value

    def of(self, text: str) -> bytes:
        """The ids of text; added tokens (the end-of-text mark) are told first, what stands between them is encoded apart."""
        if self.split and any(x in text for x in self.added):
            return b"".join(self.added.get(x) or self.plain(x) for x in self.split.split(text))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """The ids of text without added tokens. A single space before a word always begins a token, so chunks are encoded apart."""
        if not text:
            return b""
        if self.ODD.search(text):
            return b"".join(map(self.__getitem__, self.CUT.split(text)))
        first, *rest = text.split(" ")
        return (self[first] if first else b"") + b"".join(map(self.__getitem__, [" " + x for x in rest]))


_TOKENS: dict[str, Tokens] = {}


def tokens(name: str = "byte_bpe_50k") -> Tokens:
    """The worker's tokenizer: the vocabulary's ranks, which give the ids of its JSON, and the tokens that the JSON adds."""
    if name not in _TOKENS:
        import json

        import public_tokenizers

        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
            added = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
        _TOKENS[name] = Tokens(public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN, added)
    return _TOKENS[name]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, vocabulary: str = "byte_bpe_50k", ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece; with ids also the token ids (binary, uint32)."""
    schema = "id long, row long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, n = tokens(vocabulary), np.asarray([end], "<u4").tobytes(), TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(6 + ids)]
            for one, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = known.of(text) + last
                total = len(data) // 4
                start, piece = 0, 0
                while start < total:
                    stop = start + ((total - start) % length or length)
                    part, n = data[4 * start : 4 * stop], n + 1
                    for column, value in zip(out, (one, n, piece, start, stop - start, zlib.crc32(part), part), strict=False):
                        column.append(value)
                    start, piece = stop, piece + 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=False)], names=[x.split()[0] for x in schema.split(", ")])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


class Bins:
    """Bounded-space online best fit."""

    def __init__(self, length: int, most_open: int, first_id: int):
        self.length, self.most, self.next_id = length, most_open, first_id
        self.free: list[list[int]] = [[] for _ in range(length + 1)]  # bin ids by free space
        self.bits, self.open = 0, 0

    def place(self, size: int) -> tuple[int, int]:
        """The bin a piece goes to and its offset there."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            stack = self.free[free]
            which = stack.pop()
            if not stack:
                self.bits ^= 1 << free
            self.open -= 1
        else:
            which, free = self.next_id, self.length
            self.next_id += 1
            if self.open >= self.most:
                self._close_fullest()
        left = free - size
        if left:
            self.free[left].append(which)
            self.bits |= 1 << left
            self.open += 1
        return which, self.length - free

    def _close_fullest(self) -> None:
        least = (self.bits & -self.bits).bit_length() - 1
        self.free[least].pop()
        if not self.free[least]:
            self.bits ^= 1 << least
        self.open -= 1


def place(rows: DataFrame, length: int = LENGTH, most_open: int = OPEN) -> DataFrame:
    """rows (row, length, ...) with sequence_id and offset; all of a partition's pieces share its bins."""
    names = rows.columns
    schema = rows.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, held, count = Bins(length, most_open, TaskContext.get().partitionId() << 40), [], 0

        def placed() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            sizes = t.column("length").to_numpy()
            at = np.empty((len(sizes), 2), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                at[i] = bins.place(int(sizes[i]))
            t = t.append_column("sequence_id", pa.array(at[:, 0])).append_column("offset", pa.array(at[:, 1]))
            return t.to_batches()[0]

        for batch in batches:
            for i in range(0, batch.num_rows, RUN):
                held.append(batch.slice(i, RUN))
                count += held[-1].num_rows
                if count >= RUN:
                    yield placed()
                    held, count = [], 0
        if count:
            yield placed()

    # the order in a task is fixed by the rows themselves, so a task that runs again packs alike
    return rows.withColumn("turn", F.xxhash64("row")).sortWithinPartitions("turn", "row").drop("turn").select(*names).mapInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, vocabulary: str = "byte_bpe_50k", ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    made = checkpoint(pieces(docs, id_col, text_col, length, end, vocabulary, ids))
    tasks = made.filter(F.col("length") < length).count() // PIECES + 1
    whole = made.filter(F.col("length") == length).withColumns({"sequence_id": -F.col("row"), "offset": F.lit(0).cast("long")})
    packed = place(made.filter(F.col("length") < length).repartition(tasks, "row"), length)
    return packed.unionByName(whole).withColumn("id", restore_id()).withColumnRenamed("id", id_col).drop("row")
