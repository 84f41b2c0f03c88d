"""Operators against brute force on small fixtures, with nulls, empties, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelattice.llm import exact_dedup, html_text, licenses, ppm, suffix_dedup, toxicity
from carelattice.llm.decontamination import Index, contaminated, drop_contaminated
from carelattice.llm.near_dedup import drop_near_duplicates, near_duplicates, probability_jaccard, signatures
from carelattice.llm.packing import Bins, pack
from carelattice.llm.substring_dedup import substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "row", "digest", "_digest", "_gone", "_held", "one", "of", "doc", "salt", "keep", "word", "spans", "bands", "key", "label"]


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(3000)) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[tuple]:
    rng = random.Random(7)
    base = [words(rng, n) for n in (300, 120, 60, 13, 5, 4, 1, 700)]
    edited = base[0].split()
    edited[50], edited[200] = "changed", "words"
    passage = words(rng, 70)
    rows = [*base, base[0], base[0], base[2], " ".join(edited), None, "", None, " \t\n", f"{words(rng, 40)} {passage} {words(rng, 30)}", f"{passage} {words(rng, 80)}"]
    out = [(i, t, "en", "s", 0) for i, t in enumerate(rows)]
    return [*out, (None, base[1], None, None, None), (None, "lonely text", None, None, None), out[3]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_dedup(docs, texts):
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(texts)
    groups = collections.defaultdict(list)
    for i, t, *_ in texts:
        groups[t or ""].append(i)
    for r in got:
        same = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).digest() == bytes(r.digest))
        assert r.group_size == len(same)
        assert r.keep_id == max((i for i in same if i is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_dedup_weak_digest(docs):
    strong = sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect())
    weak = exact_dedup.exact_dedup(docs, digest=lambda t: F.lit("same").cast("binary"))
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in weak.collect()) == strong


def test_drop_exact_copies(docs, texts):
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.text or "" for r in got.collect()) == sorted({t or "" for _, t, *_ in texts})


def test_packing(docs, texts):
    got = pack(docs, length=64, ids=True).collect()
    by = collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= math.ceil(sum(r.length for r in got) / 64) * 1.1 + 1
    from public_tokenizers import path
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(path("byte_bpe_50k.json"))
    expected = collections.Counter(b"".join(np.asarray(known.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for _, t, *_ in texts)
    own = collections.defaultdict(dict)
    for r in got:
        if r.doc_id is not None and r.doc_id != 3:
            own[r.doc_id][r.start] = bytes(r.ids)
    assert all(b"".join(v for _, v in sorted(x.items())) in expected for x in own.values())
    assert sum(r.length for r in got) * 4 == sum(len(k) * n for k, n in expected.items())


@pytest.mark.parametrize("text", ["a  b", "a   b\n\n c", " \n x", "tab\t y ", "  ", "end ", "\n", "é  ñ 12 3a'll don't", "a   b", "<|endoftext|> x"])
def test_chunked_tokens(text):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from carelattice.llm.packing import tokens

    known = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert np.frombuffer(tokens().of(text), "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


def test_bins_close_the_fullest():
    bins = Bins(10, 2, 0)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # bin 1 had closed
    assert bins.place(4) == (0, 6) and bins.place(2) == (2, 8)


def test_ppm(docs, texts):
    got = ppm.score(docs, head=40).collect()
    tokens = [((t or "").encode().lower().split() + [b"\n"], zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t, *_ in texts]
    counts = collections.Counter(w for own, held in tokens if not held for w in own)
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted((len(own), sum(counts[w] > 0 for w in own), round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own), 6), held) for own, held in tokens)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6), r.held_out) for r in got) == expected
    assert all(r.train_tokens == total and r.score < 0 for r in got)


def test_ppm_probabilities_sum_to_one():
    rng = random.Random(3)
    data, real = ppm.stream([ppm.text_bytes(words(rng, 30).encode().split()) for _ in range(5)], 3)
    codes, counts = [], []
    full = ppm.grams(data, np.flatnonzero(real), 3)
    for j in range(4):
        c, n = np.unique(full & np.uint64((1 << (8 * (j + 1))) - 1), return_counts=True)
        codes.append(c)
        counts.append(n)
    model = ppm.train(codes, counts)
    for context in (b"a1 ", b"zzz", b" b2", b"\n\n\n", b"q12"):
        every = np.concatenate([np.frombuffer(context + bytes([b]), np.uint8) for b in range(256)])
        p = ppm.log_probabilities(model, every, np.arange(3, len(every), 4))
        assert abs((10**p).sum() - 1) < 1e-4


def test_ppm_keeps_every_node(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(2, 9))) for _ in range(40)), "en", "s", 0) for i in range(40)]
    d = spark.createDataFrame([*rows, (None, None, None, None, None)], DOCS)
    tokens = [(i, (t or "").encode().split(), zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t, *_ in [*rows, (None, None)]]
    # the trie of all training texts, read byte by byte
    trie = collections.defaultdict(collections.Counter)
    for _, own, held in tokens:
        data = b"\n" * ppm.ORDER + ppm.text_bytes(own)
        for at in range(ppm.ORDER, len(data) if not held else 0):
            for j in range(ppm.ORDER + 1):
                trie[data[at - j : at]][data[at]] += 1

    def log_of(context, symbol):
        out, excluded = 0.0, set()
        for j in range(ppm.ORDER, -1, -1):
            if j and context[ppm.ORDER - j :] not in trie:
                continue
            known = trie[context[ppm.ORDER - j :]]
            total, kinds = sum(2 * n - 1 for s, n in known.items() if s not in excluded), len(known)
            if symbol in known:
                return out + math.log10((2 * known[symbol] - 1) / (total + kinds))
            out += math.log10(kinds / (total + kinds))
            excluded |= known.keys()
        return out - math.log10(256 - len(known))

    expected = {}
    for i, own, _ in tokens:
        data = b"\n" * ppm.ORDER + ppm.text_bytes(own)
        expected[i] = sum(log_of(data[at - ppm.ORDER : at], data[at]) for at in range(ppm.ORDER, len(data)))
    for nodes in (0, 300, ppm.NODES):
        got = {r.id: r.score for r in ppm.score(d, nodes=nodes).collect()}
        assert got == pytest.approx(expected, abs=1e-3), nodes
    # parts that are given to several tasks, and tasks that take several parts in turn, a few places at a time
    monkeypatch.setattr(ppm, "TASKS", 3)
    monkeypatch.setattr(ppm, "PLACES", 500)
    got = {r.id: r.score for r in ppm.score(d, nodes=300, load=100).collect()}
    assert got == pytest.approx(expected, abs=1e-3)


def test_ppm_deals_hot_parts_to_several_tasks():
    rng = random.Random(10)
    code = np.array([rng.randrange(256) | 0x207468 << 8 for _ in range(50)], np.uint64)  # all behind one context
    deal = ppm.Deal(8, 4, {int(ppm._part(code[:1], 8)[0]): 3})
    runs = [r for b in deal.send([(code, np.ones(50, np.int64))], False) for r in b.to_pylist()]
    places = [r for turn in range(6) for b in deal.send([(code, np.arange(50))], True, turn) for r in b.to_pylist()]
    assert len({r["task"] for r in runs}) == 3 and all(np.array_equal(np.frombuffer(r["codes"], np.uint64), code) for r in runs)
    assert collections.Counter(r["task"] for r in places) == {r["task"]: 2 for r in runs}


def test_ppm_threshold(spark):
    sizes = spark.createDataFrame([(1, 50), (2, 20), (5000, 1), (5001, 1), (7000, 1)], "n long, rows long")
    assert [ppm._threshold(sizes, most) for most in (0, 1, 3, 22, 23, 100)] == [1 << 62, 7000, 5000, 5000, 2, 1]


def test_near_duplicates(docs, texts):
    got = {r.id: r for r in near_duplicates(docs).collect() if r.id is not None}
    assert got[8].class_id == got[9].class_id == got[11].class_id == 0 and got[0].kept and got[0].class_size == 4
    assert got[10].class_id == 2 and not got[10].kept
    assert {got[i].class_id for i in (12, 13, 14, 15)} == {12}
    assert all(got[i].class_id == i for i in (1, 4, 5, 6, 7, 16, 17))


def test_near_duplicates_against_all_pairs(spark):
    rng, rows = random.Random(41), []
    for family in range(25):  # copies of a text with more and more words changed, copies of copies, and texts alone
        base = words(rng, rng.randrange(60, 260)).split()
        for i in range(rng.choice([1, 4, 20, 60])):
            w = list(rng.choice([base, rows[-1][1].split()]) if i else base)
            for _ in range(rng.randrange(1, 8)):
                w[rng.randrange(len(w))] = words(rng, 1)
            rows.append((len(rows), " ".join(w)))
    assert len(rows) >= 500
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.id: r.class_id for r in near_duplicates(d).collect()}
    caught = sum(got[i] == got[j] for i, j in links)
    assert len(links) > 500 and caught >= 0.98 * len(links)
    least = list(range(len(rows)))
    for i, j in links:
        low, high = sorted((least[i], least[j]))
        least = [low if x == high else x for x in least]
    assert all(least[i] == least[c] for i, c in got.items())  # no class without links


def test_near_duplicates_of_equal_and_missing_ids(spark):
    rng = random.Random(43)
    a, b, c, e = (words(rng, 80) for _ in range(4))
    near = a.replace(a.split()[40], "other")
    rows = [(2, a), (5, near), (5, b), (None, c), (None, e), (None, near), (None, None), (7, c), (8, e), (8, e), (9, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({x: F.lit("x") for x in CLASH if x != "doc_id"})
    got = sorted((str(r.id), str(r.class_id), r.class_size, r.kept) for r in near_duplicates(d).collect())
    assert got == sorted([("2", "2", 3, True), ("5", "2", 3, False), ("None", "2", 3, False), ("5", "5", 1, True), ("None", "7", 2, False), ("7", "7", 2, True), ("None", "8", 3, False), ("8", "8", 3, True), ("8", "8", 3, False), ("None", "9", 2, False), ("9", "9", 2, True)])
    kept = drop_near_duplicates(d)
    assert kept.columns == d.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("2", a), ("5", b), ("7", c), ("8", e), ("9", "")])


def test_near_duplicates_of_large_buckets(spark):
    rng = random.Random(21)
    passage, rows = words(rng, 100), []
    for _ in range(60):  # pairs that are alike, all with one passage, but not alike to other pairs
        own = words(rng, 4)
        rows += [(len(rows) + i, f"{passage} {own} {words(rng, 10)}") for i in range(2)]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    least = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = [low if x == high else x for x in least]
    assert len(set(least)) == 60
    got = {r.id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(least))


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    common, own, other = (rng.integers(1, 1 << 62, n).astype(np.uint64) for n in (300, 60, 40))
    sides = [(np.unique(np.concatenate([common, x])), rng.integers(1, 4, 300 + len(x)).astype(float)) for x in (own, other)]
    exact = probability_jaccard(*sides)
    a, b = dict(zip(*sides[0])), dict(zip(*sides[1]))
    every = a.keys() | b.keys()
    assert abs(exact - sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in every) for i in a.keys() & b.keys())) < 1e-9
    s = signatures(sides, 4000)
    assert abs((s[0] == s[1]).mean() - exact) < 0.04


def test_substring_dedup(docs, texts):
    got = collections.defaultdict(list)
    for r in substring_dedup(docs).collect():
        got[r.id].append((r.n_words, r.n_removed, r.kept_sha256))
    own = [(i if i is not None else 1 << 62, (t or "").split()) for i, t, *_ in texts]
    first: dict = {}
    for i, w in own:
        for j in range(len(w) - 12):
            key = tuple(w[j : j + 13])
            first[key] = min(first.get(key, i), i)
    expected = collections.defaultdict(list)
    for i, w in own:
        gone = set()
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone |= set(range(j, j + 13))
        expected[None if i == 1 << 62 else i].append((len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}


def test_substring_dedup_of_many_parts(docs, texts, monkeypatch):
    from carelattice.llm import shared_keys

    expected = sorted(map(str, substring_dedup(docs).collect()))
    monkeypatch.setattr(shared_keys, "partitions_for", lambda rows, most: 23)
    monkeypatch.setattr(shared_keys, "TASKS", 2)
    monkeypatch.setattr(shared_keys, "CHUNK", 300)
    assert sorted(map(str, substring_dedup(docs.repartition(6)).collect())) == expected


def test_repeated_passages(docs, texts):
    n = suffix_dedup.LENGTH
    own = [(i, (t or "").split()) for i, t, *_ in texts]
    where = collections.defaultdict(set)
    for i, w in own:
        for j in range(len(w) - n + 1):
            where[tuple(w[j : j + n])].add(i)
    expected = {(i, k) for i, w in own for j in range(len(w) - n + 1) if len(where[tuple(w[j : j + n])]) > 1 for k in range(j, j + n)}
    assert {(r.id, k) for r in suffix_dedup.repeated_passages(docs).collect() for k in range(r.first, r.stop)} == expected


@pytest.mark.parametrize("others", [1, 3])
def test_repeated_passages_within_a_document(spark, others):
    rng = random.Random(12)
    passage = words(rng, 300)
    own = " ".join(f"{words(rng, n)} {passage}" for n in (10, 190, 100)).split()
    rows = [(1, " ".join(own)), *((2 + i, f"{words(rng, 40)} {passage} {words(rng, 30)}") for i in range(others))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.id, k) for r in suffix_dedup.repeated_passages(d).collect() for k in range(r.first, r.stop)}
    assert {k for i, k in got if i == 1} == {k for a in (10, 500, 900) for k in range(a, a + 300)}
    assert {i for i, _ in got} == {1, *range(2, 2 + others)}


def shared_windows(texts, n=suffix_dedup.LENGTH):
    where = collections.defaultdict(set)
    own = [(i, t.split()) for i, t in texts]
    for i, w in own:
        for j in range(len(w) - n + 1):
            where[tuple(w[j : j + n])].add(i)
    return {(i, k) for i, w in own for j in range(len(w) - n + 1) if len(where[tuple(w[j : j + n])]) > 1 for k in range(j, j + n)}


def test_repeated_passages_that_others_share_in_part(spark):
    # two documents share 50 to 54 words; many others share more of them with either one, but on one side only
    rng, texts = random.Random(17), []
    for family in range(60):
        core = words(rng, 50 + family % 5).split()
        cut = 16 + family % 19
        x, y = ([*words(rng, 30).split(), *core, *words(rng, 30).split()] for _ in range(2))
        rows = [x, y]
        for one in (x, y):
            for extra in (3, 12):
                rows.append([*words(rng, 5).split(), *one[30 + cut : 30 + len(core) + extra], *words(rng, 9).split()])
                rows.append([*words(rng, 5).split(), *one[30 - extra : 30 + len(core) - cut], *words(rng, 9).split()])
        texts += [(len(texts) + i, " ".join(r)) for i, r in enumerate(rows)]
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert {(r.id, k) for r in suffix_dedup.repeated_passages(d).collect() for k in range(r.first, r.stop)} == shared_windows(texts)


def test_repeated_passages_of_few_words(spark):
    rng = random.Random(23)  # few different words and many copied stretches: long runs, ties, places at the edges of texts
    pool = ["a " * 200, *(" ".join(rng.choice("abc") for _ in range(120)) for _ in range(3))]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(4):
            w = rng.choice(pool).split()
            a = rng.randrange(len(w) - 60)
            parts += w[a : a + rng.randrange(30, 60 + 60 * (i % 2))] + words(rng, 3).split()
        texts.append((i, " ".join(parts)))
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert {(r.id, k) for r in suffix_dedup.repeated_passages(d).collect() for k in range(r.first, r.stop)} == shared_windows(texts)


def test_segments():
    rng = random.Random(5)
    for _ in range(50):
        s = np.array([rng.choice([-2.0, -1.0, 1.5, 3.0]) for _ in range(30)])
        found = toxicity.segments(s)
        best = max((s[a:b].sum() for a in range(30) for b in range(a + 1, 31)), default=0)
        assert (max(x[2] for x in found) if found else 0) == pytest.approx(max(best, 0))
        assert all(x[2] == pytest.approx(s[x[0] : x[1]].sum()) for x in found)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_segments_are_the_maximal_ones():
    rng = random.Random(8)

    def maximal(s, a, b):
        """The best segment of s[a:b], and those left and right of it."""
        best = max(((sum(s[i:j]), -i, -j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        return [*maximal(s, a, -best[1]), (-best[1], -best[2]), *maximal(s, -best[2], b)]

    for _ in range(60):
        s = [rng.uniform(-2, 2) for _ in range(rng.randrange(1, 25))]
        assert [x[:2] for x in toxicity.segments(np.array(s))] == maximal(s, 0, len(s))


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        w = words(rng, 80).split()
        for _ in range(6 * bad):
            w[rng.randrange(80)] = rng.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    d = spark.createDataFrame([*rows, (None, None, None, None, None)], DOCS)
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.id: r for r in toxicity.toxicity(d, known).collect()}
    assert len(got) == 601 and all(0 <= r.score <= 1 for r in got.values())
    assert sum((got[i].score >= 0.5) == (i % 5 == 0) for i in range(600)) >= 594
    assert got[0].passages
    kept = toxicity.drop_toxic(d, known)
    assert kept.columns == d.columns and 478 <= kept.count() <= 486
    assert toxicity.toxicity(d, known.limit(0)).filter("score > 0").isEmpty()


def test_decontamination(spark):
    rng = random.Random(4)
    item = words(rng, 50)
    edited = item.replace(" ", "  ", 3).upper()
    broken = item[:100] + "xx" + item[103:]
    far = " ".join(w if i % 3 else "zz" for i, w in enumerate(item.split()))
    texts = [f"{words(rng, 30)} {item} {words(rng, 9)}", edited, f"{words(rng, 4)} {broken}", far, words(rng, 400), "", None, item[20:125]]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).withColumn("spans", F.lit(1))
    b = spark.createDataFrame([(9, item), (9, item), (10, ""), (11, None), (12, "short")], "item_id long, text string")
    got = {r.id: [s.item for s in r.spans] for r in contaminated(d, b).collect()}
    assert [bool(got[i]) for i in range(7)] == [True, True, True, False, False, False, False]
    assert not any(got[i] for i in (3, 4, 5, 6)) and all(set(x) <= {9} for x in got.values())
    assert sorted(r.doc_id for r in drop_contaminated(d, b).collect()) == [i for i in range(8) if not got[i]]
    assert drop_contaminated(d, b.limit(0)).count() == 8
    assert Index([]).find(np.zeros(50, np.uint32)) == []


@pytest.mark.parametrize("block", [2_000_000, 300])
def test_decontamination_in_blocks(spark, monkeypatch, block):
    from carelattice.llm import decontamination

    monkeypatch.setattr(decontamination, "BLOCK", block)
    rng = random.Random(14)
    items = [words(rng, 60) for _ in range(6)]
    texts = [f"{words(rng, 20)} {items[i % 6][a : a + 143]} {words(rng, 20)}" for i, a in enumerate(range(0, 60, 5))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, words(rng, 90)), (101, None), (101, ""), (None, texts[0]), (3, f"{items[0]} {items[5]}"), (3, words(rng, 50))]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASH if c != "doc_id"})
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((str(r.id), sorted({s.item for s in r.spans})) for r in contaminated(d, b).collect())
    assert got == sorted([*((str(i), [i % 6]) for i in range(12)), ("100", []), ("101", []), ("101", []), ("None", [0]), ("3", [0, 5]), ("3", [])])
    left = drop_contaminated(d, b)
    assert left.columns == d.columns and sorted(str(r.doc_id) for r in left.collect()) == ["100", "101", "101", "3"]
    assert contaminated(d.limit(0), b).count() == drop_contaminated(d.limit(0), b).count() == 0


def least_edits(pattern: str, text: str) -> int:
    """Edits of the whole pattern against any place of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            before, row[j] = row[j], min(before + (c != d), row[j] + 1, row[j - 1] + 1)
    return row[-1] if not text else min(row)


@pytest.mark.parametrize("repeats", [32, 0])
def test_decontamination_against_brute_force(spark, monkeypatch, repeats):
    from carelattice.llm import decontamination as dc

    monkeypatch.setattr(dc, "REPEATS", repeats)
    rng = random.Random(77)
    fold = lambda t: " ".join((t or "").lower().split())
    items = [words(rng, n) for n in (2, 3, 8, 20, 40)] + ["ab ab ab ab ab ab ab", "short", "", None, "é" * 30]
    texts = [None, "", "short", "x" * 300, "ab " * 40, "é" * 29]
    for _ in range(70):  # items with a growing number of edits of each kind, cut and within other words
        item = list(rng.choice(items[:5]))
        for _ in range(rng.randrange(len(item) // 9 + 2)):
            at = rng.randrange(len(item))
            item[at : at + rng.randrange(2)] = rng.choice(["", "q", "zz"])
        a = rng.choice([0, 0, rng.randrange(len(item))])
        texts.append(f"{words(rng, rng.randrange(4))} {''.join(item[a:])} {words(rng, rng.randrange(4))}")
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.id: {s.item for s in r.spans} for r in contaminated(d, b).collect()}
    expected = {}
    for i, t in enumerate(texts):
        held = lambda item, t=fold(t): any(least_edits(item[x:y], t) <= dc.budget(y - x) for x, y in dc.patterns(len(item)))
        expected[i] = {n for n, item in enumerate(items) if held(fold(item))}
    assert 20 < sum(map(bool, expected.values())) < 70
    assert got == expected
    assert sorted(r.doc_id for r in drop_contaminated(d, b).collect()) == [i for i in expected if not expected[i]]


def test_decontamination_of_repetitive_text():
    rng = random.Random(8)
    rules = [f"{words(rng, 6)} {'=' * 60} {words(rng, 4)}" for _ in range(10)]
    index = Index(list(enumerate(rules)))
    began = time.time()
    assert index.search(["=" * 20_000, "-=" * 10_000]) == [[], []]
    assert index.search(["=" * 1_000_000]) == [[]]
    (found,) = index.search([f"{'=' * 30_000} {rules[3]} {'=' * 30_000}"])
    assert {x[0] for x in found} == {3} and time.time() - began < 120


def test_decontamination_item_without_id(spark):
    item = words(random.Random(6), 50)
    d = spark.createDataFrame([(1, f"start {item} end"), (2, "clean")], "doc_id long, text string")
    b = spark.createDataFrame([(None, item)], "item_id long, text string")
    got = {r.id: {s.item for s in r.spans} for r in contaminated(d, b).collect()}
    assert got == {1: {None}, 2: set()}
    assert [r.doc_id for r in drop_contaminated(d, b).collect()] == [2]


def brute_licenses(text):
    """n_words, base places, base labels, labels and score of a text, by comparing words."""
    own = [w.decode() for w in licenses.words_of(text)]
    starts, base, found, score = [], set(), set(), 0.0
    for number, (phrase, label) in enumerate(licenses.BASE + licenses.NOTICES):
        w = phrase.split()
        pairs = len(w) - 1
        votes = collections.defaultdict(set)
        for at in range(len(own) - 1):
            for place in range(pairs):
                if own[at : at + 2] == w[place : place + 2]:
                    votes[at - place].add(place)
        whole = [d for d in votes if len(votes[d]) == pairs]
        if whole:
            found.add(label)
            score = 1.0
        if number < len(licenses.BASE):
            starts += whole
            base |= {label} if whole else set()
        elif pairs >= licenses.SHORT:
            chains = []
            for d in sorted(votes):
                if chains and d - chains[-1][-1] <= licenses.SHIFT:
                    chains[-1].append(d)
                else:
                    chains.append([d])
            for c in chains:
                span = lambda ds: max(d + max(votes[d]) for d in ds) - min(d + min(votes[d]) for d in ds)
                fits = span(c) <= 2 * pairs + licenses.SHIFT
                for ds in [c] if fits else [[e for e in c if d <= e <= d + licenses.SHIFT] for d in c]:
                    share = len(set().union(*(votes[d] for d in ds))) / pairs
                    if share >= licenses.SIMILARITY and span(ds) <= 2 * pairs + licenses.SHIFT:
                        found.add(label)
                        score = max(score, share)
    return len(own), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)), round(score, 9)


def test_licenses_against_brute_force(spark):
    rng = random.Random(31)
    phrases = [p for p, _ in licenses.BASE + licenses.NOTICES]
    rows = [None, "", "--", "MIT License", "cc by " * 9, "all rights reserved " * 5, f"{phrases[4]} " * 3, "mit license apache license, CC-BY"]
    rows += ["Licensed under the Apache License, Version 2.0 (the license); you MAY NOT use these files except in compliance", "gnu general public license " * 30 + words(rng, 30_000)]
    for _ in range(200):
        out = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(phrases).split()
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                at = rng.randrange(max(1, len(w)))
                w[at : at + rng.randrange(2)] = [rng.choice(["of", "the", "public", "license", "zz"])] * rng.randrange(3)
            out += w + rng.choice(["", "x y z", "of the license the terms"]).split()
        rows.append(" ".join(out))
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASH if c != "doc_id"})
    got = {r.id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in licenses.license_scan(d).collect()}
    assert got == {i: brute_licenses(t or "") for i, t in enumerate(rows)}


def test_html_ratios_decide(monkeypatch):
    rng = random.Random(61)
    para = lambda n: " ".join(words(rng, rng.randrange(4, 9)).capitalize() + "." for _ in range(n))
    pages, wanted = [], []
    for _ in range(40):
        body = [para(rng.randrange(2, 9)) for _ in range(6)] + [para(1)]
        head = words(rng, 6)
        menu = "".join(f"<li><a href=/{i}>{words(rng, 1)}</a></li>" for i in range(8))
        pages.append(f"<body><div class=x1><ul>{menu}</ul></div><div class=x2>{words(rng, 5)}.</div><div class=x3><h2>{head}</h2>{''.join(f'<p>{b}' for b in body)}</div><div class=x4>{words(rng, 4)}.</div></body>")
        wanted.append("\n".join([head, *body]))
    assert [html_text.main_text(p) for p in pages] == wanted  # no name, role or article tells the text here
    named = [p.replace("class=x3", "class=comments") for p in pages]
    assert [html_text.main_text(p.replace("class=x1", "class=notice").replace("<h2>", "<article><h2>")) for p in pages] == wanted
    assert not any(html_text.main_text(p) == w for p, w in zip(named, wanted))
    monkeypatch.setattr(html_text, "SHARE", 0)
    assert not any(html_text.main_text(p) == w for p, w in zip(pages, wanted))


def test_html_names_only_weigh(monkeypatch):
    rng = random.Random(62)
    para = lambda n: words(rng, n).capitalize() + ", " + words(rng, 4) + "."
    pages, wanted = [], []
    for i in range(60):  # from a few words to many, beside menus, adverts and footers of a sentence
        body = [para(rng.randrange(1, 80)) for _ in range(1 + i % 12)]
        head = words(rng, 5)
        menu = "".join(f"<li><a href=/{j}>{words(rng, 1)}</a></li>" for j in range(6))
        pages.append(f"<body><nav><ul>{menu}</ul></nav><div class=ad>{para(6)}</div><article><h1>{head}</h1>{''.join(f'<p>{b}' for b in body)}</article><footer>{para(6)}</footer>")
        wanted.append("\n".join([head, *body]))
    right = lambda change=lambda p: p: sum(html_text.main_text(change(p)) == w for p, w in zip(pages, wanted, strict=True))
    renamed = lambda p: p.replace("article>", "div>")
    assert right() == 60
    with monkeypatch.context() as m:  # a ratio that tells nothing leaves nothing right
        m.setattr(html_text, "tag_path_ratios", lambda found: {(b.path, b.named, b.article): 1.0 for b in found})
        assert right() == 0
    for names in ("_PARTS", "_LEFT_OUT", "_ROLES"):
        monkeypatch.setattr(html_text, names, frozenset())
    assert right() >= 58  # without names
    monkeypatch.setattr(html_text, "PRIOR", 1)
    assert right(renamed) >= 45  # the ratio alone


def test_html_sections_and_comments():
    text = "A sentence of some length, with marks in it. "
    two = f"<div class=a><p>{text * 9}<p>{text * 8}</div><div class=menu><a href=x>Go on</a></div><div class=b><p>{text * 7}<p>{text * 6}</div>"
    assert html_text.main_text(two).count("\n") == 3 and "Go on" not in html_text.main_text(two)
    comments = f"<article><p>{text * 9}<p>{text * 9}<div class=comments><p>{text * 3}<p>{text}<p>{text * 2}</div></article>"
    assert html_text.main_text(comments).count("\n") == 1


@pytest.mark.parametrize("page", ["<a " * 40_000, "<div>" * 20_000 + "x", "<b>" * 5000 + "<p>x" * 5000, "<b>" * 5000 + "</div>" * 10_000, "<!" * 40_000, '<a "' * 30_000 + ">", "<script>" + "</script " * 30_000, "&amp;" * 50_000, "<!-- x"])
def test_hostile_pages(page):
    import time

    began = time.time()
    text = html_text.main_text(page)
    assert time.time() - began < 10 and len(text) <= len(page)
    assert html_text.main_text("<article><p>Fine text.</p></article>" + page).startswith("Fine text.")


def test_html_queries(spark):
    rows = [(1, "u", "<p>One, two."), (1, None, None), (None, "u", ""), (2, "u", "<article><p>" + "Long text. " * 100_000 + "</article>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "id", "path", "n_chars")})
    got = html_text.extract(d)
    assert got.columns == ["page_id", "url", "id", "path", "n_chars", "text"]
    assert sorted(len(r.text) for r in got.collect()) == [0, 0, 9, 1_099_999]
    assert html_text.extract(d.limit(0)).count() == 0


def test_html_text():
    page = """<html><head><title>T</title></head><body><header><a href="/">Site</a></header><nav><ul><li>Menu</ul></nav>
    <div class="ad">Buy now!</div><article><h1>Title &amp; more</h1><p><b>One,   two.<br>Three &lt;b&gt;.<p>Second paragraph, long enough to count.
    <script>var x="</p>";</script><form><p>Mail</p></form><ul><li>Point</li></ul><section class="comments"><p>First!</p></section></article>
    <footer>&copy; Us</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more\nOne, two. Three <b>.\nSecond paragraph, long enough to count.\nPoint"
    plain = "<div id=menu><a href=x>A</a></div><div><h2>Head</h2><p>A long sentence, with marks. And another one, as long.</p><p>Third of them, it is fine.</p></div><div><a href=y>next page</a></div>"
    assert html_text.main_text(plain) == "Head\nA long sentence, with marks. And another one, as long.\nThird of them, it is fine."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("1 < 2 and <b>3") == "1 < 2 and 3"


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x, y.</p>"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(3))
    assert sorted(str(r) for r in html_text.extract(pages).collect()) == ["Row(page_id=1, url='u', text='x, y.')", "Row(page_id=None, url=None, text='')"]


def test_licenses(spark):
    mit = licenses.NOTICES[0][0].split()
    del mit[7]
    texts = ["Under the MIT-License; or the Apache license (GNU General Public License)!", " ".join(["word", *mit, "end"]).title(), "mit", None, "", "cc by cc by", "gnu public license"]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).withColumns({c: F.lit(1) for c in CLASH})
    got = {r.id: r for r in licenses.license_scan(d).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (12, 3, 2, 8, "apache,gpl,mit")
    assert got[1].labels == "mit" and got[1].base_labels == "" and 0.6 < got[1].score < 1
    assert (got[5].n_base, got[5].first_word, got[5].last_word, got[5].labels) == (2, 0, 2, "cc-by")
    assert all(got[i].n_base == 0 and got[i].first_word is None and got[i].labels == "" and got[i].score == 0 for i in (2, 3, 4, 6))


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert pack(empty).count() == 0
    assert ppm.score(empty).count() == 0
    assert near_duplicates(empty).count() == 0
    assert substring_dedup(empty).count() == 0
    assert suffix_dedup.repeated_passages(empty).count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    assert licenses.license_scan(empty).count() == 0
