"""Sentence pieces, hard negatives and the prefix trie against the library and brute force, with nulls, empties, ties and repeats."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from carelattice.llm import hard_negatives as hn
from carelattice.llm import prefix_trie as pt
from carelattice.llm import queries as q
from carelattice.llm.sentence_pieces import decode, encode, vocabulary

DOCS = "doc_id long, text string, id string, ids string, decoded string, n_tokens string"
TURNS = "conv_id long, turn long, role string, text string, conv string, depth string, node string, key string, part string"
VECTORS = "vec_id long, embedding array<double>, label int, anchor string, id string, score string, block string, chunk string"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _strange(rng: random.Random, library) -> list[str]:
    known = vocabulary()
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    early = [pieces[i - 259] for i in range(259, 32000) if known.early[i]]
    some = [" ", "  ", "a", "e", "the", "▁", "é", "日", "\n", "=", "1", "🙂", "́", "то", "\x00"]
    out = ["", " ", "   ", " a", "a ", "a  b", "▁x ▁▁", "<s> </s> <unk>", "\t\r\n", "a" * 3000, "ab" * 900, "=" * 5000, "日本語" * 300, " " * 700 + "x", "🙂" * 300]
    for parts, n, size in ((some, 300, 40), (pieces, 200, 12), (early, 200, 12), (list("abcdefghijklmnopqrstuvwxyz"), 20, 1500), ([p.replace("▁", "") for p in early], 20, 400)):
        out += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, size))) for _ in range(n)]
    out += ["".join(chr(c) for c in (rng.randrange(0x10FFFF) for _ in range(30)) if not 0xD800 <= c < 0xE000) for _ in range(100)]
    return out


def test_pieces_against_the_library(spark, library):
    texts = [*_strange(random.Random(4), library), None]
    docs = spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in enumerate(texts)] + [(None, "no id", *"xxxx"), (3, "twice", *"xxxx"), (3, "twice", *"xxxx")], DOCS)
    got = encode(docs).collect()
    assert len(got) == len(texts) + 3
    own = {r.id: r for r in got if r.id is not None and r.id != 3}
    for i, r in own.items():
        ids = library.encode(texts[i] or "")
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ",".join(map(str, ids)), library.decode(ids)), texts[i]
    assert sorted((r.id, r.decoded) for r in got if r.id == 3) == [(3, texts[3]), (3, "twice"), (3, "twice")]


def test_decode_any_ids(spark, library):
    rng = random.Random(6)
    rows = [(i, [rng.choice([rng.randrange(32000), rng.randrange(259), rng.randrange(3), 29871, 243, 162, 131]) for _ in range(rng.randrange(8))], "x") for i in range(3000)]
    got = decode(spark.createDataFrame([*rows, (-1, None, "x")], "i int, ids array<int>, decoded string")).collect()
    assert {r.i: r.decoded for r in got} == {**{i: library.decode(ids) for i, ids, _ in rows}, -1: None}


def test_pieces_of_a_long_text(library):
    rng = random.Random(2)
    began = time.time()
    for text in ("=" * 1_000_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)), "word and  another " * 100_000):
        ((n, ids, decoded),) = vocabulary().encode([text])
        assert decoded.decode() == text and n == ids.count(b",") + 1
    assert time.time() - began < 60
    text = "".join(rng.choice("etaoin") for _ in range(30_000)) + " end"
    assert vocabulary().encode([text])[0][1] == ",".join(map(str, library.encode(text))).encode()


def brute_negatives(rows, is_anchor, label_of, n=5, k=3, low=50, high=95):
    used = [(i, label_of(i, label), [math.floor(256 * x) for x in v]) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, label, v) in enumerate(used):
        if not is_anchor(i):
            continue
        order = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for b, (j, other, w) in enumerate(used) if b != at)
        for s, p, _ in [x for x in order if x[2] == label][:n]:
            found = [(j, -t) for t, j, other in order if other != label and -low * s <= -100 * t <= -high * s][:k]
            out += [(i, p, rank, j, -s, t) for rank, (j, t) in enumerate(found, 1)]
    return sorted(out)


def _vectors(rng, n, dims=6, grid=None):
    value = (lambda: rng.choice(grid)) if grid else (lambda: rng.gauss(0.3, 0.4))
    rows = [(i, [value() for _ in range(dims)], rng.randrange(3)) for i in range(n)]
    return rows + [(n, None, 1), (n + 1, [1.0] * dims, None), (n + 2, [float("nan")] * dims, 1), (n + 3, [float("inf")] + [0.0] * (dims - 1), 1), (n + 4, [None] * dims, 2), (None, [1.0] * dims, 1), (n + 5, [], 1), (n + 6, [0.5, 0.5], 0), (30, [0.4] * dims, 1), (30, [0.4] * dims, 1)]


@pytest.mark.parametrize("grid", [None, [0.0, 0.5, 1.0]])
def test_hard_negatives_against_brute_force(spark, grid, monkeypatch):
    monkeypatch.setattr(hn, "TOGETHER", 2)
    monkeypatch.setattr(hn, "CHUNK", 4)
    rows = _vectors(random.Random(9), 300, grid=grid)
    df = spark.createDataFrame([(*r, *"xxxxx") for r in rows], VECTORS).repartition(5)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, label).collect()
    expected = brute_negatives(rows, lambda i: i % 10 == 0, lambda i, y: (y + 1) % 3 if i % 7 == 0 else y)
    assert sorted(map(tuple, got)) == expected and len(expected) > 100


def test_exact_scores():
    import numpy as np

    big = np.array([[2.0**31, 3.0, -(2.0**30)]])
    assert hn.scores(big, big).tolist() == [[2**62 + 9 + 2**60]]
    assert hn.scores(np.array([[2.0**40, -1.0]]), np.array([[2.0**40, 5.0], [-(2.0**40), 0.0]])).tolist() == [[2**63 - 1, -(2**63 - 1)]]


def test_hard_negatives_of_little(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [-1.0], 1), (1, [1.0], 1), (2, [1.0], 2)]):
        df = spark.createDataFrame([(*r, *"xxxxx") for r in rows], VECTORS)
        assert hn.hard_negatives(df, F.col("vec_id") == 0).collect() == []
    wide = spark.createDataFrame([(0, [1.0] * 3000, 1, *"xxxxx"), (1, [1.0] * 3000, 1, *"xxxxx"), (2, [0.9] * 3000, 2, *"xxxxx")], VECTORS)
    assert [tuple(r) for r in hn.hard_negatives(wide, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2, 256 * 256 * 3000, 256 * 230 * 3000)]


def brute_trie(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    sign = lambda c: -((-c) % 5) if c < 0 else c % 5
    path = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        path[c] = turns.get(c - sign(c), [])[:h] + own[h:]
    nodes = collections.defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            nodes[tuple(p[:d])].append(c)
    kids = collections.defaultdict(list)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = (len(nodes[n]) - 1) * (len(n[-1][1].encode()) if n else 0) + sum(saved[k] for k in kids[n])
    digest = lambda n: hashlib.sha256(",".join(str(c) for c in sorted(nodes[n]) if len(path[c]) == len(n)).encode()).hexdigest()
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], digest(n)) for n, m in nodes.items())


def _show(rows):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows)


def test_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pt, "SEGMENT", 3)
    monkeypatch.setattr(pt, "CHAIN", 4)
    rng = random.Random(12)
    rows = []
    for c in [*range(-12, 60), *range(200, 240), (1 << 63) - 1, -(1 << 63), (1 << 63) - 3]:
        shared = rng.choice([["a", "b", "a", "é", "b", "a", "a", "b", "c", "d"], ["a"] * 12, []])
        own = shared[: rng.randrange(len(shared) + 1)] + [rng.choice("abc") for _ in range(rng.randrange(14))]
        rows += [(c, i if i else None, rng.choice(["user", "user", None]), rng.choice([x, x, x, None])) for i, x in enumerate(own)]
    for c in range(300, 340):  # copies
        rows += [(c, i, "user", "same") for i in range(12)]
    rows += [(7, 3, "user", "a"), (7, 3, "user", "a"), (7, 3, "tool", "b"), (None, 1, "user", "lost"), (400, None, None, None), (401, 1, "r", "")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, *"xxxxx") for r in rows], TURNS).repartition(4)
    got = pt.conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    expected = brute_trie(rows)
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(_rows(got.collect()), key=key) == sorted(expected, key=key)


def _rows(rows):
    return [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows]


def test_trie_of_little(spark):
    assert pt.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    # conversation 1 takes more turns from its absent base than it has: only the root is left of it
    h = zlib.crc32(b"1") % 9
    rows = [(1, i, "user", "x") for i in range(h)]
    got = pt.conversation_trie(spark.createDataFrame([(*r, *"xxxxx") for r in rows], TURNS)).collect()
    assert _rows(got) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    long = spark.range(30_000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = pt.conversation_trie(long.unionByName(spark.createDataFrame([(10, 0, "user", "0")], "conv_id long, turn long, role string, text string")))
    assert got.count() == 30_001 and got.filter("n_leaves = 1").count() == 30_001


def test_queries_against_sql(spark, tmp_path):
    import duckdb

    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for name, query in (("embeddings", "op12_hard_negatives"), ("conversations", "op13_prefix_trie")):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
        got = q.queries()[query](spark, sf)
        columns = ", ".join(got.columns)
        expected = con.sql(f"SELECT {columns} FROM ({q.oracle_sql()[query]})").fetchall()
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def _pairs(n: int, with_ids: bool) -> list[tuple]:
    rng = random.Random(n)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(150)) for _ in range(n)]
    return [(i if with_ids else None, t) for i, t in enumerate([*texts, *texts])]


def test_rows_without_ids_are_documents(spark):
    from carelattice.llm.substring_dedup import substring_dedup
    from carelattice.llm.suffix_dedup import repeated_passages

    frame = lambda n, ids: spark.createDataFrame(_pairs(n, ids), "doc_id long, text string").repartition(4)
    # a copy of either is removed whole, whichever comes first
    for n in (100, 2000):
        took = {}
        for ids in (True, False):
            began = time.time()
            got = substring_dedup(frame(n, ids)).groupBy("n_removed").count().collect()
            took[ids] = time.time() - began
            assert sorted(map(tuple, got)) == [(0, n), (150, n)]
    assert took[False] < 3 * took[True] + 5
    for ids in (True, False):
        spans = repeated_passages(frame(100, ids)).collect()
        assert len(spans) == 200 and {(r.first, r.stop) for r in spans} == {(0, 150)} and all((r.id is None) == (not ids) for r in spans)
