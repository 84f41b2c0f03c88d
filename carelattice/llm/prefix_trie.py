"""A trie over the turns of conversations: which conversations share how many first turns, and what sharing them saves.

Level-synchronous: for each depth, the turns at that depth of live conversations are grouped by (parent node, next turn),
and a node is named after its smallest conversation. A conversation that is alone in its node leaves: the rest of its path
is a chain and is written down without another join. When no node is shared any more, joins from the deepest level upwards
roll up leaves and savings. So there are as many levels as the longest prefix that two conversations share.

Turns stand for themselves by a SHA-256 digest of role and text. Positions come from one sort by ranges of all turns and
counts by partition, so that a conversation of any length is spread over tasks; groups combine before they are shuffled.

Defined results: rows without a conversation id belong to no conversation. Null turns come first, null roles and texts are
empty; turns of one number are ordered by role, then text (a repeated row is a turn of its own). A table without
conversations has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, partitions_for, release

#: Members' ids that go into one row of text when a node's digest is made.
SEGMENT = 1500
#: Turns of a chain that one row is unfolded to at a time.
CHAIN = 1024


def turn_table(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos (from 0), n (turns of the conversation), key (digest), size (bytes of the text): one row for each turn."""
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    order = ["conv", "turn", "role", "text"]
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    sorted_rows = rows.repartitionByRange(partitions_for(conversations), *order).sortWithinPartitions(*order)
    made = checkpoint(sorted_rows.select("conv", key.alias("key"), F.octet_length("text").cast("long").alias("size"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    starts, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in made.groupBy("part").agg(F.count("*").alias("n")).collect()):  # one row a partition
        starts.append((part, total))
        total += n
    if not starts:
        return made.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("n"), "key", "size")
    offsets = conversations.sparkSession.createDataFrame(starts, "part int, start long")
    placed = made.join(F.broadcast(offsets), "part").select("conv", "key", "size", (F.col("start") + F.col("at")).alias("at"))
    firsts = placed.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return placed.join(firsts, "conv").select("conv", (F.col("at") - F.col("first")).alias("pos"), "n", "key", "size")


def rebuilt(turns: DataFrame, group: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group: (conv, depth, key, size), and (conv, length).

    Conversation c starts with the first h turns of c - c % group, h being crc32 of its decimal id modulo `modulus`, and
    goes on with its own turns after its first h.
    """
    turns = checkpoint(turns)
    sizes = turns.filter("pos = 0").select("conv", "n")
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % modulus).alias("h")
    base = F.col("conv") - F.col("conv") % group
    convs = sizes.select("conv", "n", head, base.alias("base")).join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("m")), "base", "left")
    shift = F.least(F.col("h"), F.coalesce("m", F.lit(0)))
    convs = checkpoint(convs.select("conv", "base", "h", shift.alias("shift"), (shift + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    # a turn may be wanted by its own conversation and, if it is one of the first of a base, by those of its group
    near = [F.try_add(F.col("conv"), F.lit(i).cast("long")) for i in range(1 - group, group)]
    others = F.filter(F.array(*near), lambda x: (x.isNotNull()) & (x != F.col("conv")) & (x - x % group == F.col("conv")))
    wanted = F.when((F.col("conv") % group == 0) & (F.col("pos") < modulus - 1), F.concat(F.array("conv"), others)).otherwise(F.array("conv"))
    sent = turns.select(F.col("conv").alias("source"), "pos", "key", "size", F.explode(wanted).alias("conv")).join(convs, "conv")
    borrowed, own = (F.col("source") == F.col("base")) & (F.col("pos") < F.col("h")), (F.col("source") == F.col("conv")) & (F.col("pos") >= F.col("h"))
    depth = F.when(borrowed, F.col("pos") + 1).when(own, F.col("shift") + F.col("pos") - F.col("h") + 1)
    rows = checkpoint(sent.select("conv", depth.alias("depth"), "key", "size", "length").filter("depth is not null"))
    release(turns)
    return rows, convs.select("conv", "length")


def ends_digest(ends: DataFrame) -> DataFrame:
    """depth, node, ends_sha256 of rows (depth, node, conv): SHA-256 of the ids in order, joined by commas.

    A digest has to see a node's ids in order, however many there are: tasks of a global order join them to segments, and
    one task for each node takes the segments one after another.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> list[tuple]:
            return [(*at, held[0], ",".join(map(str, held)))] if held else []

        for batch in batches:
            out = []
            for depth, node, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (depth, node) or len(held) >= SEGMENT:
                    out += done()
                    at, held = (depth, node), []
                held.append(conv)
            yield pa.RecordBatch.from_pylist([dict(zip(("depth", "node", "first", "ids"), x, strict=True)) for x in out], schema)
        yield pa.RecordBatch.from_pylist([dict(zip(("depth", "node", "first", "ids"), x, strict=True)) for x in done()], schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for batch in batches:
            out = []
            for depth, node, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == (depth, node):
                    sha.update(b"," + ids.encode())
                    continue
                if at:
                    out.append((*at, sha.hexdigest()))
                at, sha = (depth, node), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("depth", "node", "ends_sha256"), x, strict=True)) for x in out], result)
        if at:
            yield pa.RecordBatch.from_pylist([dict(zip(("depth", "node", "ends_sha256"), (*at, sha.hexdigest()), strict=True))], result)

    kinds = [("depth", pa.int64()), ("node", pa.int64())]
    schema, result = pa.schema([*kinds, ("first", pa.int64()), ("ids", pa.string())]), pa.schema([*kinds, ("ends_sha256", pa.string())])
    order = ["depth", "node", "conv"]
    segments = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth long, node long, first long, ids string")
    return segments.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").mapInArrow(digest, "depth long, node long, ends_sha256 string")


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("string").cast("binary"), 256)


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """All nodes of the trie over paths (conv, depth from 1, key, size, length) of conversations (conv, length).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    lengths = checkpoint(lengths)
    root = lengths.agg(F.min("conv").alias("root"), F.count("*").alias("n")).first()
    spark, zero = rows.sparkSession, F.lit(0).cast("long")
    # level 0: the root holds all conversations, those without a turn end in it
    levels = [spark.createDataFrame([(None, root.root, root.n, 0)] if root.n else [], "parent long, node long, n long, size long").withColumn("length", zero)]
    ends = [lengths.filter("length = 0").select(zero.alias("depth"), F.lit(root.root).cast("long").alias("node"), "conv")]
    live = rows.select("conv", F.lit(root.root).cast("long").alias("parent"), "depth", "key", "size", "length")
    kept: list[DataFrame] = []
    while True:
        depth = len(levels)
        here = live.filter(F.col("depth") == depth)
        groups = checkpoint(here.groupBy("parent", "key").agg(F.min("conv").alias("node"), F.count("*").alias("n"), F.max("size").alias("size"), F.max("length").alias("length")))
        if groups.isEmpty():
            break
        levels.append(groups)
        shared = groups.filter("n > 1")
        members = checkpoint(here.join(shared.select("parent", "key", F.col("node").alias("next")), ["parent", "key"]).select("conv", "next", "length"))
        ends.append(members.filter(F.col("length") == depth).select(F.lit(depth).cast("long").alias("depth"), F.col("next").alias("node"), "conv"))
        going = members.filter(F.col("length") > depth).select("conv", "next")
        live = checkpoint(live.filter(F.col("depth") > depth).join(going, "conv").select("conv", F.col("next").alias("parent"), "depth", "key", "size", "length"))
        release(*kept)
        kept = [live]
    # upwards: what the children of a level give to their parents
    done, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        own = levels[depth].filter("n > 1") if depth else levels[0]
        own = own.select("parent", "node", "n", ((F.col("n") - 1) * F.col("size")).alias("saved"))
        if below is None:
            up = own.withColumns({"children": zero, "leaves": F.lit(1).cast("long")})
        else:
            sums = below.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"))
            up = own.join(sums, "node", "left").select(
                "parent", "node", "n", (F.col("saved") + F.coalesce("below", zero)).alias("saved"), F.coalesce("children", zero).alias("children"), F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves")
            )
        up = checkpoint(up)
        done.append(up.withColumn("depth", F.lit(depth).cast("long")))
        if depth:
            single = levels[depth].filter("n = 1").select("parent", F.lit(1).cast("long").alias("leaves"), zero.alias("saved"))
            below = up.select("parent", "leaves", "saved").unionByName(single)
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    ended = ends[0]
    for x in ends[1:]:
        ended = ended.unionByName(x)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    tree = every.join(ends_digest(ended), ["depth", "node"], "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
    # chains: a conversation alone from depth `start` on, unfolded in runs of bounded length
    chains = None
    for depth, groups in enumerate(levels[1:], 1):
        one = groups.filter("n = 1").select("node", "parent", F.lit(depth).cast("long").alias("start"), "length")
        chains = one if chains is None else chains.unionByName(one)
    if chains is None:
        return tree
    runs = chains.select("*", F.explode(F.sequence("start", "length", F.lit(CHAIN).cast("long"))).alias("run"))
    steps = runs.select("*", F.explode(F.sequence("run", F.least(F.col("run") + CHAIN - 1, "length"))).alias("depth"))
    last, one = F.col("depth") == F.col("length"), F.lit(1).cast("long")
    alone = steps.select(
        F.col("node").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("start"), F.col("parent")).otherwise(F.col("node")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(last, _sha(F.col("node"))).otherwise(empty).alias("ends_sha256"),
    )
    return tree.unionByName(alone)


def conversation_trie(conversations: DataFrame, group: int = 5, modulus: int = 9) -> DataFrame:
    """The trie of the conversations, rebuilt so that those of a group share their beginnings."""
    return prefix_trie(*rebuilt(turn_table(conversations), group, modulus))
