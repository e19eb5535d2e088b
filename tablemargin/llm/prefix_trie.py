"""The trie of conversations that begin alike.

A node of depth d stands for a sequence of d turns; the conversations that begin with it are its members.  Conversations
are grouped by blocks of a fixed number of turns first: a digest of all turns up to the end of a block tells the members
of the block apart.  Where all that go on after a block's end share the next block, every turn inside it has the same
members, and nothing finer is looked at; only in blocks where siblings diverge are turns grouped one by one.

Each node is known by its smallest member and its depth.  The nodes that one conversation is the smallest member of are
a chain down to its last turn, so sums over subtrees need no walk through the levels: a chain gives its totals once to
each chain above it, at the depth where its path leaves that one, and a window sums each chain from the bottom.

All grouping is by partial aggregation, so a turn that a third of all conversations begin with is no hot group; windows
are on one conversation, whose turns are streamed through a sort.  What must pass one task is a digest over the sorted
ids that end at one node, as the digest is sequential: the ids are gathered in pages of `PAGE` first, and a task streams
the pages without holding more than one Arrow batch of them.

Turns are in order of `turn`, NULL first, ties by role and text, so the order of rows does not matter and a repeated row
is a turn of its own.  NULL roles and texts are empty ones; rows without conv_id belong to no conversation and are left
out.  An empty table has no nodes, not even a root.  Extra columns are not read.  Sequences are compared by two 64-bit
digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablemargin.sources.tables import stage

#: Turns of a block.
BLOCK = 4
#: Ids of one page: page k has those from k * PAGE on.
PAGE = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, two digests of role and text, n_bytes of the text) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), F.xxhash64("role", "text").alias("x1"),
                       F.xxhash64(F.lit(1), "text", "role").alias("x2"), F.octet_length("text").cast("long").alias("n_bytes"))


def shared_openings(turns: DataFrame) -> DataFrame:
    """Turns of conversations rebuilt to begin like others; every conversation has at least a row, without a place if it has no turn.

    With h the crc32 of the id modulo 9, conversation c has the first h turns of c - c % 5, then its own after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h")
    ids = turns.select("conv_id").distinct().select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    opening = turns.filter("place <= 8").withColumnRenamed("conv_id", "base")
    own = turns.withColumn("h", h).filter("place > h")
    return (ids.join(opening, "base").filter("place <= h").select("conv_id", F.lit(0).alias("part"), "place", "x1", "x2", "n_bytes")
            .unionByName(own.select("conv_id", F.lit(1).alias("part"), "place", "x1", "x2", "n_bytes"))
            .unionByName(ids.select("conv_id", F.lit(2).alias("part")), allowMissingColumns=True))


def _prefixes(turns: DataFrame, block: int) -> DataFrame:
    """Each turn with its depth, the digests of all turns so far, and those before and at the end of its block.

    Rows of part 2 only name the conversation and get depth 0.
    """
    of = Window.partitionBy("conv_id")
    order = of.orderBy("part", "place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_block = Window.partitionBy("conv_id", "block")
    rows = turns.withColumn("depth", F.when(F.col("part") < 2, F.row_number().over(order)).otherwise(0))
    # Digests of turns are bound to their depth, so that adding them up without an order still tells sequences apart.
    for p, seed in (("p1", 11), ("p2", 12)):
        turn = F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "x1", "x2")).otherwise(F.lit(0).cast("long"))
        rows = rows.withColumn(f"t{p}", turn).withColumn(p, F.bit_xor(f"t{p}").over(so_far))
    rows = rows.withColumn("block", F.when(F.col("depth") > 0, F.floor((F.col("depth") - 1) / block)).otherwise(-1))
    rows = rows.withColumns({
        "last": F.max("depth").over(of), "end": F.max(F.struct("depth", "p1", "p2")).over(in_block),
        "begin": F.min(F.struct("depth", F.col("p1").bitwiseXOR(F.col("tp1")).alias("b1"), F.col("p2").bitwiseXOR(F.col("tp2")).alias("b2"))).over(in_block)})
    return rows.select("conv_id", "depth", "last", "p1", "p2", "n_bytes", "block", F.col("begin.b1").alias("b1"), F.col("begin.b2").alias("b2"),
                       F.col("end.depth").alias("e0"), F.col("end.p1").alias("e1"), F.col("end.p2").alias("e2"))


def _members(rows: DataFrame) -> DataFrame:
    """Each row with the size and smallest member of its node; `rows` are those of `_prefixes` below the root."""
    ends = rows.filter("depth = e0").groupBy("block", "e0", "e1", "e2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.min("b1").alias("b1"), F.min("b2").alias("b2"))
    ends = stage(ends, "trie-blocks")
    siblings = ends.groupBy("block", "b1", "b2").agg((F.count("*") > 1).alias("diverge"))
    ends = ends.join(siblings, ["block", "b1", "b2"]).select("block", "e0", "e1", "e2", "n_convs", "owner", "diverge")
    rows = stage(rows.join(ends, ["block", "e0", "e1", "e2"]).select(
        "conv_id", "depth", "last", "p1", "p2", "n_bytes", "n_convs", "owner", "diverge"), "trie-turns")
    split = rows.filter("diverge").drop("n_convs", "owner")
    found = split.groupBy("depth", "p1", "p2").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"))
    kept = ["conv_id", "depth", "last", "n_bytes", "n_convs", "owner"]
    return rows.filter("not diverge").select(kept).unionByName(split.join(found, ["depth", "p1", "p2"]).select(kept))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from (owner, depth, conv_id)."""
    pages = ends.groupBy("owner", "depth", F.floor(F.col("conv_id") / PAGE).alias("page")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []

        def batch() -> pa.RecordBatch:
            owners, depths, hashes = zip(*done) if done else ((), (), ())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(depths, pa.int32()), pa.array(hashes, pa.string())],
                                              names=["owner", "depth", "ends_sha256"])

        for rows in batches:
            for owner, depth, ids in zip(*(rows.column(c).to_pylist() for c in ("owner", "depth", "ids"))):
                if (owner, depth) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (owner, depth), hashlib.sha256(ids.encode())
            yield batch()
        if node:
            done.append((*node, state.hexdigest()))
        yield batch()

    return (pages.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "page")
            .mapInArrow(digest, "owner long, depth int, ends_sha256 string"))


def trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes of the trie over `turns` (conv_id, part, place, x1, x2, n_bytes), which are in order of part and place.

    A row of part 2 says that a conversation exists, with or without turns.
    """
    rows = stage(_prefixes(turns, block), "trie-prefixes")
    convs = rows.filter("depth = 0")
    whole = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("owner")).first()
    top = convs.select("conv_id", "depth", "last", F.lit(0).cast("long").alias("n_bytes"), F.lit(whole.n).alias("n_convs"),
                       F.lit(whole.owner).cast("long").alias("owner"))
    path = top.unionByName(_members(rows.filter("depth > 0")))
    path = stage(path.withColumn("parent", F.lag("owner").over(Window.partitionBy("conv_id").orderBy("depth"))), "trie-paths")

    nodes = path.filter("owner = conv_id").withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes"))
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["owner", "depth"], "left").fillna(0, ["n_children"])
    nodes = stage(nodes.select("owner", "depth", "parent", "n_convs", "n_children", "saved",
                               (F.col("n_children") == 0).cast("long").alias("leaf")), "trie-nodes")
    # Where a chain's path leaves each chain above it.
    chains = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    above = path.filter("owner <> conv_id").groupBy("conv_id", "owner").agg(F.max("depth").alias("depth"))
    given = above.join(chains, "conv_id").groupBy("owner", "depth").agg(F.sum("saved").alias("below_saved"), F.sum("leaf").alias("below_leaf"))
    downwards = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = nodes.join(given, ["owner", "depth"], "left").fillna(0, ["below_saved", "below_leaf"]).select(
        "owner", "depth", "parent", "n_convs", "n_children",
        F.sum(F.col("leaf") + F.col("below_leaf")).over(downwards).alias("n_leaves"),
        F.sum(F.col("saved") + F.col("below_saved")).over(downwards).alias("saved_tokens"))
    ends = _end_digests(path.filter("depth = last").select("owner", "depth", "conv_id"))
    return summed.join(ends, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
        *[F.col(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, rebuild: bool = False, block: int = BLOCK) -> DataFrame:
    """Nodes of the trie over conversations (conv_id, turn, role, text), as they are or with `shared_openings`."""
    turns = stage(ordered_turns(conversations), "trie-ordered")
    if rebuild:
        return trie(shared_openings(turns), block)
    named: Column = F.lit(2).alias("part")
    return trie(turns.withColumn("part", F.lit(1)).unionByName(turns.select("conv_id").distinct().select("conv_id", named), allowMissingColumns=True), block)
