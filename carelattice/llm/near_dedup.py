"""Near-duplicate detection by ProbMinHash.

A document is the weighted set of its five-word shingles (weight: one plus the logarithm of how often it occurs, so that
a line repeated a hundred times doesn't outweigh a text). Every shingle is a Poisson
process with its weight as rate whose arrivals fall on random signature slots; a slot keeps the earliest arrival. A
shingle's later arrivals are only drawn while they can still be earlier than the latest slot of its document. Two
documents agree in a slot with the probability Jaccard similarity of their weighted sets. BANDS bands of ROWS slots give
the candidates; these are verified with the exact Jaccard similarity of the whole shingle sets (or, if asked for, the
exact probability Jaccard of the weighted sets; without repeated shingles both are the same), and links are joined to classes.

Skew: texts with the same words are one representative, found by a combining aggregation. In a bucket of at most PAIRED
representatives each pair is a candidate. In a larger one each member meets the bucket's head, the member that shares
most buckets with others (the least edited copy), also found by a combining aggregation. A head's shingle set is sent once
for each MEMBERS of its candidates, not with every pair. Members that are then outside the largest class of a bucket meet
further heads while there are many of them and a round places a good part. Those that are still outside are compared with all members of
their bucket, in blocks of bounded bytes that are spread over tasks (an inverted index of a block's shingles tells the
similarities), so the classes are those of all candidate pairs and no bucket is held in one task.

Defined results: null text is empty; texts without words are copies of each other; texts of fewer than five words have
one shingle, the whole text; every row is judged by its own text, so rows with equal ids or without an id are classed
apart if their texts are. A class is named by its least id (null if none of its rows has one); the row with the least id
is kept, one of them if several have it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, checkpoint, filter_position, hash_words, id_and_text, id_filter, may_contain, mix, release, restore_id, rolling, slices, split_words, sweep, text_digest
from .components import components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
PAIRED = 12
SALTS = 8
#: Candidates that one copy of a head's set serves.
MEMBERS = 256
#: Comparisons for each member of a bucket of several classes up to which it is compared whole at once.
EACH = 2000
#: Bytes of packed sets in a block of outside members, and in the chunk of members that it meets.
BLOCK, CHUNK = 1 << 20, 1 << 22


def shingles(words: list[bytes], k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their weights."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    h = hash_words(words)
    h = rolling(h, k) if len(h) >= k else rolling(h, len(h))
    found, weights = np.unique(h, return_counts=True)
    return found, 1 + np.log(weights)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """ProbMinHash signatures (rows of shingle hashes) of non-empty weighted sets."""
    sizes = [len(s) for s, _ in sets]
    s, w = np.concatenate([x[0] for x in sets]), np.concatenate([x[1] for x in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    best = np.full(len(sets) * slots, np.inf)
    held = np.zeros(len(sets) * slots, np.uint64)
    t, turn = np.zeros(len(s)), 0
    while len(s):
        turn += 1
        u = mix(s + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        t = t - np.log(((u >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / w
        slot = doc * slots + ((mix(u) >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(best, slot, t)
        first = best[slot] == t
        held[slot[first]] = s[first]
        on = t < best.reshape(-1, slots).max(1)[doc]
        s, w, doc, t = s[on], w[on], doc[on], t[on]
    return held.reshape(-1, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact, for sorted distinct keys with weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = a[1][i], b[1][j]
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    # of the common keys up to here in this order y_j / y_i is the larger ratio, of those after it x_j / x_i
    return float((1 / ((x[::-1].cumsum()[::-1] - x + only_x) / x + (y.cumsum() + only_y) / y)).sum())


def _packed(words: list[bytes]) -> bytes:
    found, weights = shingles(words)
    keys, at = np.unique((found >> np.uint64(32)).astype("<u4"), return_inverse=True)
    w = np.bincount(at, weights).astype("<f4")
    return len(keys).to_bytes(4, "little") + keys.tobytes() + (w.tobytes() if (w != 1).any() else b"")


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    keys = np.frombuffer(data, "<u4", n, 4)
    return keys, np.frombuffer(data, "<f4", n, 4 + 4 * n).astype(float) if len(data) > 4 + 4 * n else np.ones(n)


def _content(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 33
    for batch in slices(batches):
        content, sets, some = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = split_words(text)
            content.append(_content(words))
            if words:
                some.append(i)
                sets.append(shingles(words))
        bands: list[list[int] | None] = [None] * len(content)
        if sets:
            keys = band_keys(signatures(sets, BANDS * ROWS), BANDS, ROWS).view(np.int64).tolist()
            for i, k in zip(some, keys, strict=True):
                bands[i] = k
        uids = pa.array(np.arange(uid, uid + len(content)))
        uid += len(content)
        yield pa.RecordBatch.from_arrays([uids, batch.column("id"), batch.column("digest"), pa.array(content, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["uid", "id", "digest", "content", "bands"])


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of the keys alone."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    return both / max(1, len(a[0]) + len(b[0]) - both)


def _linked(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _verified(limit: float, weighted: bool):
    """Links of heads (rows without a) with the members that follow them."""
    measure = probability_jaccard if weighted else jaccard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            out = []
            for a, b, packed in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "packed")), strict=True):
                if a is None:
                    head, own = b, _unpacked(packed)
                elif head == b and measure(own, _unpacked(packed)) >= limit:
                    out.append((a, b))
            yield _linked(out)

    return run


def _links(pairs: DataFrame, packed: DataFrame, limit: float, weighted: bool) -> DataFrame:
    """The pairs (a, b) that are alike. b's set is sent once for each MEMBERS members, not with every pair."""
    pairs = checkpoint(pairs)
    counts = checkpoint(pairs.groupBy("b").agg((F.count("*") / MEMBERS).cast("long").alias("most")))
    dealt = pairs.join(counts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("most") + 1).alias("salt"))
    members = dealt.join(packed.withColumnRenamed("rep", "a"), "a").select("a", "b", "salt", "packed")
    heads = dealt.select("b", "salt").distinct().join(packed.withColumnRenamed("rep", "b"), "b").select(F.lit(None).cast("long").alias("a"), "b", "salt", "packed")
    rows = heads.unionByName(members).repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    links = checkpoint(rows.mapInArrow(_verified(limit, weighted), "u long, v long"))
    release(pairs, counts)
    return links


def bucket_links(outside: np.ndarray, classes: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], limit: float, weighted: bool = False) -> Iterator[tuple[int, int]]:
    """Pairs of an outside member and another, limit or more alike, that join classes as all such pairs would."""
    cls = classes.copy()
    sizes = np.array([len(k) for k, _ in sets])
    keys, owner = np.concatenate([k for k, _ in sets]), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    for x in np.flatnonzero(outside).tolist():
        low, high = np.searchsorted(keys, sets[x][0]), np.searchsorted(keys, sets[x][0], "right")
        n = high - low
        both = np.bincount(owner[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(sets))
        other = (both > 0) & (cls != cls[x])
        if not weighted:
            other &= both / np.maximum(1, sizes[x] + sizes - both) >= limit
        for y in np.flatnonzero(other).tolist():
            if cls[y] != cls[x] and (not weighted or probability_jaccard(sets[x], sets[y]) >= limit):
                yield x, y
                cls[cls == cls[y]] = cls[x]


def _across(limit: float, weighted: bool):
    """Links between classes. Rows: key, block, chunk, outside, rep, component, packed, in the order of the first three."""

    def linked(rows: list[tuple]) -> list[tuple[int, int]]:
        classes = np.unique([r[5] for r in rows], return_inverse=True)[1]
        return [(rows[x][4], rows[y][4]) for x, y in bucket_links(np.array([r[3] for r in rows]), classes, [_unpacked(r[6]) for r in rows], limit, weighted)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "chunk", "outside", "rep", "component", "packed")), strict=True):
                if held and held[0][:3] != row[:3]:
                    out += linked(held)
                    held.clear()
                held.append(row)
            yield _linked(out)
        if held:
            yield _linked(linked(held))

    return run


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members (key, rep, degree) of the buckets that are in several classes: component, outside (not in the bucket's largest class)."""
    placed = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    held = placed.groupBy("key", "component").agg(F.count("*").alias("held"))
    main = held.groupBy("key").agg(F.max_by("component", "held").alias("main"), F.count("*").alias("classes")).filter("classes > 1").select("key", "main")
    return checkpoint(placed.join(checkpoint(main), "key").select("key", "rep", "degree", "component", (F.col("component") != F.col("main")).alias("outside")))


def _whole(placed: DataFrame, packed: DataFrame, limit: float, weighted: bool) -> DataFrame:
    """Links of each bucket's outside members with all its members, dealt in blocks of both by the bytes of their sets."""
    rows = placed.join(packed, "rep")
    bytes_of = rows.groupBy("key").agg(F.sum(F.length("packed")).alias("chunks"), F.sum(F.when(F.col("outside"), F.length("packed"))).alias("blocks"))
    bytes_of = bytes_of.select("key", (F.col("chunks") / CHUNK).cast("int").alias("chunks"), (F.col("blocks") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(checkpoint(bytes_of), "key")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n)))
    one_of = lambda n: F.pmod(F.xxhash64("rep", F.lit(n)), F.col(n) + 1).cast("int")
    queries = rows.filter("outside").withColumn("block", one_of("blocks")).withColumn("chunk", all_of("chunks"))
    members = rows.withColumn("chunk", one_of("chunks")).withColumn("block", all_of("blocks")).withColumn("outside", F.lit(False))
    both = queries.unionByName(members).select("key", "block", "chunk", "outside", "rep", "component", "packed")
    dealt = both.repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk", "rep", "outside")
    return checkpoint(dealt.mapInArrow(_across(limit, weighted), "u long, v long").distinct())


def _classified(docs: DataFrame, id_col: str, text_col: str, similarity: float, weighted: bool) -> DataFrame:
    """uid, id, digest (of the text), class_id, class_size, kept of every row; ids as id_and_text has them."""
    spark = docs.sparkSession
    sweep(spark)
    rows = id_and_text(docs, id_col, text_col)
    signed = checkpoint(rows.withColumn("digest", text_digest("text")).mapInArrow(_sign, "uid long, id long, digest binary, content binary, bands array<long>"))
    # a representative for each different text: its row with the least id
    reps = checkpoint(signed.groupBy("content").agg(F.min(F.struct("id", "uid")).alias("least"), F.first("bands").alias("bands"), F.count("*").alias("copies")).withColumn("rep", F.col("least.uid")))

    exploded = reps.filter("bands is not null").select("rep", F.explode("bands").alias("key"))
    # written out, so that both sides of the join are plain shuffles and a large bucket can be split among tasks
    sizes = checkpoint(exploded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    buckets = checkpoint(exploded.join(sizes, "key").withColumn("degree", F.sum("n").over(Window.partitionBy("rep"))))  # at most BANDS rows in a window
    small, large = buckets.filter(F.col("n") <= PAIRED).select("key", "rep"), buckets.filter(F.col("n") > PAIRED).select("key", "rep", "degree")

    members = reps.join(buckets.select("rep").distinct(), "rep", "left_semi").select("rep", "content", F.col("least.id").alias("id"))
    bits = id_filter(members)
    filtered, size = spark.sparkContext.broadcast(bits), 8 * len(bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(filtered.value, np.uint8)
        for batch in slices(batches):
            batch = batch.filter(pa.array(may_contain(known, batch.column("at").to_numpy())))
            words = [split_words(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_content(w) for w in words], pa.binary()), pa.array([_packed(w) for w in words], pa.binary())], names=["content", "packed"])

    # texts are read again only for documents whose id may be that of one in a bucket
    read = rows.withColumn("at", filter_position(size)).mapInArrow(pack, "content binary, packed binary")
    packed = checkpoint(read.join(members.select("rep", "content"), "content").groupBy("rep").agg(F.min("packed").alias("packed")))

    def stars(of: DataFrame, heads: DataFrame) -> DataFrame:
        return of.select("key", F.col("rep").alias("a")).join(heads, "key").select("a", "b").filter("a <> b").distinct()

    pairs = small.select("key", F.col("rep").alias("a")).join(small.select("key", F.col("rep").alias("b")), "key").filter("a > b").select("a", "b").distinct()
    first = stars(large, checkpoint(large.groupBy("key").agg(F.max_by("rep", "degree").alias("b"))))
    edges = _links(pairs.unionByName(first), packed, similarity, weighted)
    found = checkpoint(components(edges))
    sweep(spark)
    turn, before = 0, None
    while True:
        placed = _placed(large, found)
        of = placed.groupBy("key").agg(F.count("*").alias("n"), F.count_if("outside").alias("out"))
        rows_left, cost = of.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("out")), F.lit(0))).first()
        # rounds go on while comparing what is left whole is dear, and a round saves a fifth of it at least
        if cost <= EACH * rows_left or before is not None and cost > 0.8 * before:
            break
        turn, before = turn + 1, cost
        heads = checkpoint(placed.groupBy("key", "outside").agg(F.max_by("rep", F.xxhash64("rep", F.lit(turn))).alias("b")).select("key", "b"))
        edges = edges.unionByName(_links(stars(placed.filter("outside"), heads), packed, similarity, weighted))
        found = components(edges)
        release(placed, heads)
    if cost:
        # what joins classes: links between their names
        name = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(f"{c}_of"))
        gained = _whole(placed, packed, similarity, weighted).join(name("u"), "u", "left").join(name("v"), "v", "left")
        joined = components(gained.select(F.coalesce("u_of", "u").alias("u"), F.coalesce("v_of", "v").alias("v")))
        new = joined.select(F.col("id").alias("component"), F.col("component").alias("main"))
        alone = joined.join(found.select("id"), "id", "left_anti")  # names that no link had before
        found = found.join(new, "component", "left").select("id", F.coalesce("main", "component").alias("component")).unionByName(alone)
    found = checkpoint(found)
    release(sizes, buckets, packed, placed)
    sweep(spark)

    of = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("content", "copies", "least", F.coalesce("component", "rep").alias("class"))
    classes = of.groupBy("class").agg(F.min("least").alias("first"), F.sum("copies").alias("class_size")).filter("class_size > 1")
    spread = of.select("content", "class").join(classes, "class").select("content", "first", "class_size", F.explode(F.array([F.lit(i) for i in range(SALTS)])).alias("salt"))
    out = signed.select("uid", "id", "digest", "content", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).alias("salt")).join(spread, ["content", "salt"], "left")
    return out.select("uid", "id", "digest", F.coalesce("first.id", "id").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), (F.coalesce("first.uid", "uid") == F.col("uid")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """id, class_id (the least id of its class), class_size, kept (one row of each class) of every row."""
    found = _classified(docs, id_col, text_col, similarity, weighted)
    return found.select(restore_id().alias("id"), restore_id("class_id").alias("class_id"), "class_size", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all columns: that with the least id.

    Rows are told by id and text, so unlike texts under one id, or under none, stay. Of rows that agree in both, one stays.
    """
    groups = _classified(docs, id_col, text_col, SIMILARITY, False).groupBy("id", "digest")
    seen = checkpoint(groups.agg(F.max("kept").alias("stays"), F.count("*").alias("rows")).filter("not stays or rows > 1"))
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), text_digest(text_col).alias("digest"))
    out = out.join(seen.filter("not stays").select("id", "digest"), ["id", "digest"], "left_anti")
    if not seen.filter("stays").isEmpty():
        out = out.dropDuplicates(["id", "digest"])
    return out.select("doc.*")
