"""Encoding and decoding with a SentencePiece BPE vocabulary, by vectorised merge rounds.

A text is one array of symbols, one for each character, cut into words where no piece of the vocabulary can reach over. A
round finds the best-ranked pair of neighbours in every word (a segmented minimum), merges all of that pair's leftmost
occurrences at once, looks the new pairs up and closes the gaps; words without a pair left are done. Merging all occurrences
at once gives what merging one by one gives, unless a merged symbol makes a pair that ranks still higher; for such symbols
only occurrences further apart than the longest piece are merged in one round.

Words of more than LONG symbols (text without spaces) would need as many rounds over the whole word as it has different
pairs; there, rounds take the occurrences of a rank from buckets, so a round costs what it merges.

What a worker has encoded of short words it remembers, up to a bound. Characters outside the vocabulary become byte pieces;
decoding puts the pieces' bytes together and takes off the space that encoding put in front.

Defined results: null text is empty, an empty text has no ids. Only what the vocabulary is made for is supported: BPE,
identity normalisation, a space in front, spaces kept, byte pieces for unknown characters; others raise ValueError.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import id_and_text, restore_id, slices

SPACE = "▁"
NONE = np.int32(np.iinfo(np.int32).max)
#: Symbols of a word from which on rounds take occurrences from buckets.
LONG = 256
#: Words that a worker remembers, and their longest.
REMEMBERED, SHORT = 400_000, 64
#: Characters of a text that are handled at once; a text is cut before a space.
PART = 1 << 19


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _one_byte)


class Vocabulary:
    """Tables of a model: symbols are piece ids, or `size` + code point for characters that are no piece."""

    WORD = re.compile(f"{SPACE}({SPACE}*[^{SPACE}]*)")

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)])
        if any(map(model.is_unused, range(n))) or model.normalize(" ﬁ  x ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}" or not all(i >= 0 and model.is_byte(i) for i in (model.piece_to_id(f"<0x{b:02X}>") for b in range(256))):
            raise ValueError("an identity-normalised vocabulary with byte pieces is needed")
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        pieces = {names[i]: i for i in range(n) if not special[i]}
        if any(a != SPACE and b == SPACE for p in pieces for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("pieces that reach over the start of a word aren't supported")
        self.longest = max(map(len, pieces))
        self.of_char = np.arange(0x110000, dtype=np.int32) + np.int32(n)
        for p, i in pieces.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        known = lambda s: pieces.get(s, n + ord(s) if len(s) == 1 else None)
        merges = [(a, b, i) for p, i in pieces.items() for k in range(1, len(p)) if (a := known(p[:k])) is not None and (b := known(p[k:])) is not None]
        left, right, made = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        self.wide = n + 0x110000
        keys = left * self.wide + right
        order = np.argsort(keys)
        self.keys, self.made = keys[order], made[order].astype(np.int32)
        score = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)  # best first
        # pieces that take part in a pair of better rank than their own
        self.early = np.zeros(n, bool)
        for part in (left, right):
            inner = part < n
            self.early[part[inner][self.rank[made[inner]] <= self.rank[part[inner]]]] = True
        touching = {ord(a) * 0x110000 + ord(b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.touching = np.sort(np.fromiter(touching, np.int64, len(touching)))
        self.text = [str(i).encode() for i in range(n)]
        self.raw = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.bytes.tolist()):
            self.raw[i] = bytes([b])
        self.byte_ids = set(self.bytes.tolist())
        self.known: dict[str, tuple[int, bytes, bytes]] = {}

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What pairs of symbols merge to; NONE if they don't."""
        key = a.astype(np.int64) * self.wide + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made == NONE, NONE, self.rank[np.minimum(made, self.size - 1)])

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words (ascending) after all merges, still in order of words."""
        made = np.full(len(symbols), NONE, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        made[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            rank = self.ranks(made)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            if (best == NONE).any():
                gone = np.repeat(best == NONE, sizes)
                done_symbols.append(symbols[gone])
                done_words.append(word[gone])
                symbols, word, made, rank = symbols[~gone], word[~gone], made[~gone], rank[~gone]
                sizes, best = sizes[best != NONE], best[best != NONE]
                if not len(symbols):
                    break
            at = self._apart(np.flatnonzero(rank == np.repeat(best, sizes)), made, word)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, made = symbols[keep], word[keep], made[keep]
            at = at - np.arange(len(at))  # each merge before it took one symbol away
            for i in (at[at > 0] - 1, at[at < len(symbols) - 1]):
                made[i] = np.where(word[i] == word[i + 1], self.pairs(symbols[i], symbols[i + 1]), NONE)
            made[-1] = NONE
        if not done_symbols:
            return symbols, word
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], word[order]

    def _apart(self, at: np.ndarray, made: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The occurrences that are merged in this round: the leftmost of overlapping ones, and distant ones of early pieces."""
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (place[at[1:]] != place[at[:-1]])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
        early = self.early[made[at]]
        if early.any():
            near = np.concatenate([[False], (at[1:] - at[:-1] < self.longest) & (place[at[1:]] == place[at[:-1]])])
            at = at[~(early & near)]
        return at

    def long_word(self, symbols: np.ndarray) -> np.ndarray:
        """The merges of one long word: buckets of places by rank, neighbours as links."""
        n = len(symbols)
        symbols = symbols.copy()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        made = np.append(self.pairs(symbols[:-1], symbols[1:]), NONE).astype(np.int32)
        buckets: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(at: np.ndarray) -> None:
            at = at[made[at] != NONE]
            rank = self.rank[made[at]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for part, r in zip(np.split(at, cuts), rank[np.concatenate([[0], cuts])].tolist() if len(at) else (), strict=False):
                if r not in buckets:
                    buckets[r] = []
                    heapq.heappush(heap, r)
                buckets[r].append(part)

        put(np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(buckets.pop(r)))
            at = at[(symbols[at] >= 0) & (made[at] != NONE)]
            at = at[self.rank[made[at]] == r]
            if not len(at):
                continue
            touch = np.concatenate([[False], after[at[:-1]] == at[1:]])
            first = np.maximum.accumulate(np.where(touch, 0, np.arange(len(at))))
            left = (np.arange(len(at)) - first) % 2 == 0
            if self.early[made[at]].any():
                left &= ~(self.early[made[at]] & np.concatenate([[False], at[1:] - at[:-1] < self.longest]))
            put(at[~left])  # those that still hold come back, before worse ranks
            at = at[left]
            gone = after[at]
            symbols[at] = made[at]
            symbols[gone] = -1
            made[gone] = NONE
            after[at] = after[gone]
            inner = at[after[at] < n]
            before[after[inner]] = inner
            made[at] = NONE
            made[inner] = self.pairs(symbols[inner], symbols[after[inner]])
            lead = before[at[before[at] >= 0]]
            made[lead] = self.pairs(symbols[lead], symbols[after[lead]])
            put(np.unique(np.concatenate([inner, lead])))
        return symbols[symbols >= 0]

    def words(self, found: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Of each word (without the mark in front): how many ids, the ids as decimal text, what they decode to."""
        sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
        chars = np.frombuffer((SPACE + SPACE.join(found)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(found)), sizes)
        symbols = self.of_char[chars]
        # a word falls into parts where no piece has these two characters side by side
        pair = chars[:-1] * 0x110000 + chars[1:]
        at = np.minimum(np.searchsorted(self.touching, pair), len(self.touching) - 1)
        part = np.concatenate([[0], np.cumsum((self.touching[at] != pair) | (word[1:] != word[:-1]))])
        length = np.bincount(part)
        long = length[part] > LONG
        out_symbols, out_parts = self.rounds(symbols[~long], part[~long])
        if long.any():
            starts = np.searchsorted(part, np.arange(len(length) + 1))
            runs = [(i, self.long_word(symbols[starts[i] : starts[i + 1]])) for i in np.flatnonzero(length > LONG).tolist()]
            out_symbols = np.concatenate([out_symbols, *(s for _, s in runs)])
            out_parts = np.concatenate([out_parts, *(np.full(len(s), i) for i, s in runs)])
            order = np.argsort(out_parts, kind="stable")
            out_symbols, out_parts = out_symbols[order], out_parts[order]
        word_of_part = word[np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))]
        out_word = word_of_part[out_parts]
        strange = out_symbols >= self.size
        if strange.any():
            out_symbols, out_word = self._as_bytes(out_symbols, out_word, strange)
        cuts = np.searchsorted(out_word, np.arange(len(found) + 1)).tolist()
        ids = out_symbols.tolist()
        text, raw = list(map(self.text.__getitem__, ids)), list(map(self.raw.__getitem__, ids))
        return [(b - a, b",".join(text[a:b]), b"".join(raw[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _as_bytes(self, symbols: np.ndarray, word: np.ndarray, strange: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols, those outside the vocabulary replaced by byte pieces."""
        code = np.where(strange, symbols - self.size, 0)
        each = np.where(strange, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        out = np.repeat(symbols, each)
        out[np.repeat(strange, each)] = self.bytes[np.frombuffer("".join(map(chr, code[strange].tolist())).encode("utf-8", "surrogatepass"), np.uint8)]
        return out, np.repeat(word, each)

    def encode(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Of each text: how many ids, the ids as decimal text, the decoded text in UTF-8."""
        split = [[w for part in _parts(t) for w in _words(part)] for t in texts]
        seen: set[str] = set()
        for x in split:
            seen.update(x)
        fresh = list(seen - self.known.keys())
        if fresh:
            self.known.update(zip(fresh, self.words(fresh), strict=True))
        out = []
        for x in split:
            counts, ids, raw = zip(*map(self.known.__getitem__, x), strict=True) if x else ((), (), ())
            out.append((sum(counts), b",".join(ids), b"".join(raw)[1:]))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        else:
            for w in fresh:
                if len(w) > SHORT:
                    del self.known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control pieces say nothing, of a run of byte pieces each byte that isn't UTF-8 becomes U+FFFD."""
        out, begun = [], False
        for is_byte, run in groupby(ids, key=self.byte_ids.__contains__):
            data = b"".join([self.raw[i] for i in run])
            out.append(data.decode("utf-8", "each_byte"))
            if not begun and data:
                begun = True
                if not is_byte and out[-1].startswith(" ") and not out[-1].startswith(" ⁇ "):
                    out[-1] = out[-1][1:]
        return "".join(out)


def _parts(text: str) -> Iterator[str]:
    """The text in parts that are cut at a single space (which is left out)."""
    at = 0
    while len(text) - at > PART:
        cut = text.find(" ", at + PART)
        while cut > 0 and " " in (text[cut - 1], text[cut + 1 : cut + 2]):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    if text:
        yield text[at:]


def _words(text: str) -> list[str]:
    """The words of a text that follows a space, without the mark that each begins with."""
    if SPACE in text or "  " in text or text[:1] == " ":
        return Vocabulary.WORD.findall(SPACE + text.replace(" ", SPACE))
    return text.split(" ")


_KNOWN: dict[str, Vocabulary] = {}


def vocabulary(name: str = "piece_bpe_32k") -> Vocabulary:
    """The worker's vocabulary."""
    if name not in _KNOWN:
        import public_tokenizers

        _KNOWN[name] = Vocabulary(public_tokenizers.path(f"{name}.model"))
    return _KNOWN[name]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "piece_bpe_32k") -> DataFrame:
    """id, n_tokens, ids (decimal, joined by commas) and decoded (what decoding the ids gives) of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(name)
        for batch in slices(batches):
            counts, ids, decoded = zip(*known.encode(batch.column("text").to_pylist()), strict=True)
            text = pa.array([x.decode("utf-8", "each_byte") for x in decoded], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array([x.decode() for x in ids], pa.string()), text], names=["id", "n_tokens", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids string, decoded string").withColumn("id", restore_id())


def decode(rows: DataFrame, ids_col: str = "ids", name: str = "piece_bpe_32k") -> DataFrame:
    """rows (of which ids_col holds an array of ids) with their text as `decoded`; null ids have none."""
    rows = rows.drop("decoded")
    out = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(name)
        for batch in batches:
            texts = [None if x is None else known.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)
