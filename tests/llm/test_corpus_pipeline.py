"""The pipeline's stages on a small corpus: what each removes, and that clean documents stay."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np

import corpus_pipeline
from carelattice.llm import decontamination, toxicity
from carelattice.llm.licenses import words_of
from .test_operators import DOCS, least_edits, words


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(300):
        w = words(rng, 90).split()
        bad = i % 6 == 0
        for _ in range(7 * bad):
            w[rng.randrange(90)] = rng.choice(["vile", "nasty", "rotten"])
        rows.append([i, " ".join(w), "en", "s", 0])
        labels.append((i, 1, int(bad)))
    item = words(rng, 40)
    rows[1][1] = rows[2][1]  # a copy: the larger id stays
    near = rows[3][1].split()
    near[5] = "other"
    rows[4][1] = " ".join(near)  # a near copy: one stays
    rows[5][1] = f"{rows[5][1]} {item}"  # holds a benchmark passage
    rows += [[300, None, None, None, None], [301, "", "en", "s", 0]]
    for name, data, schema in (("documents", rows, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, item)], "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id for r in docs.collect()}
    clean = set(range(302)) - set(range(0, 300, 6))
    assert len(clean - kept["toxicity"]) <= 3 and len(kept["toxicity"] - clean) <= 3
    assert kept["toxicity"] - kept["exact_dedup"] == {1, 300}
    assert kept["exact_dedup"] - kept["near_dedup"] == {4}
    assert kept["near_dedup"] - kept["decontamination"] == {5}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == kept["decontamination"]


def test_odd_and_empty_tables(spark, tmp_path):
    odd = [(1, "a b c"), (1, "a b c"), (1, "other text"), (None, "x y"), (None, "z w"), (2, None), (3, "")]
    for name, rows, left in (("none", [], []), ("odd", odd, ["1", "1", "3", "None", "None"])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, folder).collect()) == left


def brute_segments(scores: list[float]) -> list[float]:
    """Sums of the maximal-scoring segments: the best one, then those of what lies on either side."""
    total, least, at, best = 0.0, 0.0, 0, (0.0, 0, 0)
    for i, x in enumerate(scores):
        total += x
        if total - least > best[0] + 1e-9:
            best = (total - least, at, i + 1)
        if total < least:
            least, at = total, i + 1
    return [*brute_segments(scores[: best[1]]), best[0], *brute_segments(scores[best[2] :])] if best[0] > 0 else []


def brute_toxicity(spark, docs, labels):
    model = toxicity.fit(docs, labels)
    known = toxicity.Scores(model.weights)
    bad = set()
    for r in docs.collect():
        scores = [known[w] for w in words_of(r.text or "")]
        if toxicity.probability(model, brute_segments(scores), len(scores)) >= 0.5:
            bad.add(r.doc_id)
    return bad


def brute_exact(texts):
    last = collections.defaultdict(list)
    for i, t in texts.items():
        last[t or ""].append(i)
    return {i for same in last.values() for i in same if i != max(same)}


def brute_near(texts):
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, (t or "").split()) for i, t in texts.items())}
    least = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and least[i] != least[j] and a and len(a & b) >= 0.8 * len(a | b):
                low, high = sorted((least[i], least[j]))
                least = {k: low if x == high else x for k, x in least.items()}
    return {i for i, x in least.items() if x != i}


def brute_leaks(texts, items):
    fold = lambda t: " ".join((t or "").lower().split())
    return {i for i, t in texts.items() if any(least_edits(item[a:b], fold(t)) <= decontamination.budget(b - a) for item in map(fold, items) for a, b in decontamination.patterns(len(item)))}


def test_stages_against_brute_force(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng, texts = random.Random(31), []
    items = [words(rng, 30) for _ in range(3)]
    for _ in range(60):  # families of exact and near copies, and copies of copies
        w = words(rng, 70).split()
        texts.append(" ".join(w))
        for _ in range(rng.choice([0, 1, 4])):
            if rng.random() < 0.6:
                w[rng.randrange(70)] = words(rng, 1)
            texts.append(" ".join(w))
    for k in range(8):  # benchmark items, whole, changed and in part
        item = list(rng.choice(items))
        for _ in range(3 * k):
            item[rng.randrange(len(item))] = "q"
        texts.append(f"{words(rng, 12)} {''.join(item[10 * k:])} {words(rng, 12)}")
    for k in range(70):  # toxic ones, some barely
        w = words(rng, 70).split()
        for _ in range(1 + k % 8):
            w[rng.randrange(70)] = rng.choice(["vile", "nasty", "rotten"])
        texts.append(" ".join(w))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*texts, None, "", " ", "few words"])]
    rng.shuffle(rows)
    bad = len(texts) - 70
    for name, data, schema in (("documents", rows, DOCS), ("labels", [(i, 1, int(bad <= i < bad + 70)) for i in range(len(texts))], "doc_id long, quality int, toxic int"), ("benchmark", list(enumerate(items)), "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(4).write.parquet(f"{tmp_path}/{name}.parquet")
    labels, left = spark.read.parquet(f"{tmp_path}/labels.parquet"), {r[0]: r[1] for r in rows}
    checks = {"toxicity": lambda d, t: brute_toxicity(spark, d, labels), "exact_dedup": lambda d, t: brute_exact(t), "near_dedup": lambda d, t: brute_near(t), "decontamination": lambda d, t: brute_leaks(t, items)}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        gone = checks[name](docs, left)
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/after/{name}")
        docs = spark.read.parquet(f"{tmp_path}/after/{name}")
        left = {i: t for i, t in left.items() if i not in gone}
        assert gone and {r.doc_id: r.text for r in docs.collect()} == left, name
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    for i, t in left.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert sorted(pieces.pop(i)) == [(0, len(ids), zlib.crc32(ids.tobytes()))]
    assert not pieces
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
