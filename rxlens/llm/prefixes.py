"""Conversation prefix trie by ROLLUP over positional turn columns.

A turn becomes an id (a digest of role and text) and its length; texts travel no further. A
conversation becomes blocks of ``WIDTH`` turn columns, and one ``ROLLUP`` over these columns
aggregates every prefix that ends in a block; ``grouping_id`` tells its depth. A block is keyed
by the node that the conversation's earlier blocks lead to, named by a 128-bit digest of their
turns, so long conversations continue in further blocks of the same grouping and their depth
adds no job.

What holds for whole subtrees is summed without walking the trie:

* A node is named by its smallest member and its depth. A conversation is the smallest member
  from some depth on (``first_depth``) and then down to its end.
* A node without children is counted once, at its smallest member. So the leaves below a node
  are the members that stand for a leaf.
* Every node's text is saved by all its members but the smallest. So what a subtree saves is,
  summed over its members, the lengths of their turns from the node's depth down to where they
  become the smallest member. All members share the turns above, so this is a sum per member
  less a number known from the node.

The first ``ROLLUP`` finds the smallest members, the second sums. Map tasks combine equal
prefixes before the shuffle, so a prefix that a third of all conversations share leaves each
task as one row. Lists of member ids are cut into chunks by id value (at most ``2 **
CHUNK_BITS`` ids in one) and digested as a stream, chunk after chunk; no list is held whole.

Defined results: rows without a conversation id are left out; a null turn comes first, rows of
equal turn are ordered by their ids (digests), so repeated rows are repeated turns; null roles
and texts are empty. An empty table has no nodes, not even a root. Extra columns are not read.
One conversation's turns are numbered by one task, which spills to disk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.llm.arrow import batch_of
from rxlens.operators.reuse import checkpoint_stage

WIDTH = 8
#: Conversation ids that agree above these bits are digested as one chunk.
CHUNK_BITS = 12
STARTS = 6
SPAN = 100
NODE = ("depth", "k1", "k2")
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_rows(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (1, 2, ...), ``id`` and ``chars`` of every turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("id"),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id", "chars")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "id", "chars")


def shared_starts(turns: DataFrame, starts: int = STARTS, span: int = SPAN) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of c - c % span, then its own after h.

    h is the CRC-32 of c in decimal, modulo ``starts``. Returns turns, and for a conversation
    that comes out empty one row with a null ``pos``.
    """
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % starts
    own = turns.withColumn("h", share)
    ids = own.select("conv_id", "h").distinct()
    # At most starts - 1 turns of a base, and span - 1 conversations on either side of it.
    heads = (
        turns.filter((F.col("conv_id") % span == 0) & (F.col("pos") < starts))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.collect_list(F.struct("pos", "id", "chars")).alias("turns"))
    )
    begun = ids.withColumn("base", F.expr(f"conv_id - conv_id % {span}")).join(heads, "base", "left")
    first = F.filter("turns", lambda t: t["pos"] <= F.col("h"))
    begun = begun.select("conv_id", F.explode_outer(first).alias("t"))
    begun = begun.select("conv_id", "t.pos", "t.id", "t.chars")
    # A base with fewer than h turns is followed by the conversation's own turns after h.
    return begun.unionByName(own.filter("pos > h").drop("h"))


def blocks_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per conversation and block: ``t1`` to ``t<width>``, the key of the node before it
    (``p1``, ``p2``), the characters before it (``before``) and the conversation's length."""
    order = Window.partitionBy("conv_id").orderBy("pos")
    counted = turns.withColumn("at", F.row_number().over(order) - 1)
    # The row that stands for an empty conversation sorts first and counts as no turn.
    none = F.max(F.col("pos").isNull().cast("int")).over(Window.partitionBy("conv_id"))
    counted = counted.withColumn("at", F.col("at") - none)
    counted = counted.filter("pos is not null or at = -1")
    place = F.greatest("at", F.lit(0))
    slot = place % width
    turn = F.struct("id", "chars")
    known = F.col("pos").isNotNull()
    columns = [
        F.max(F.when(known & (slot == i), turn)).alias(f"t{i + 1}") for i in range(width)
    ]
    wide = counted.groupBy("conv_id", F.expr(f"greatest(at, 0) div {width}").alias("block")).agg(
        *columns, F.count("pos").alias("here")
    )
    names = [f"t{i + 1}" for i in range(width)]
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    chars = sum((F.coalesce(F.col(f"{t}.chars"), F.lit(0)) for t in names), F.lit(0).cast("long"))
    out = wide.withColumn("block_chars", chars)
    k1, k2 = block_key(F.col("block"), names)
    return out.select(
        "conv_id",
        "block",
        *names,
        F.coalesce(F.bit_xor(k1).over(before), F.lit(0).cast("long")).alias("p1"),
        F.coalesce(F.bit_xor(k2).over(before), F.lit(0).cast("long")).alias("p2"),
        F.coalesce(F.sum("block_chars").over(before), F.lit(0).cast("long")).alias("before"),
        F.sum("here").over(whole).alias("turns"),
    )


def block_key(block: Column, names: list[str]) -> tuple[Column, Column]:
    """Two 64-bit digests of a block's turns; with no turn at all, zero."""
    some = F.col(names[0]).isNotNull()
    ids = [F.col(f"{t}.id") for t in names]
    zero = F.lit(0).cast("long")
    return tuple(
        F.when(some, F.xxhash64(F.lit(salt), block, *ids)).otherwise(zero) for salt in (1, 2)
    )


def rolled_up(blocks: DataFrame, aggregates: str, width: int = WIDTH) -> DataFrame:
    """Aggregates (SQL) per trie node: ``ROLLUP`` over the turn columns of each block.

    Adds the node's ``depth`` and key, its parent's, the characters of its last text and those
    of all texts above it.
    """
    names = [f"t{i + 1}" for i in range(width)]
    keys = ["block", "p1", "p2", "before"]
    grouped = blocks.sparkSession.sql(
        f"SELECT {', '.join(keys + names)}, grouping_id() AS rolled, {aggregates} "
        f"FROM {{blocks}} GROUP BY {', '.join(keys)}, ROLLUP({', '.join(names)})",
        blocks=blocks,
    )
    # Each turn column that is rolled away sets one bit.
    nodes = grouped.withColumn("level", F.lit(width) - F.bit_count("rolled"))
    last = F.element_at(F.array(*names), F.greatest("level", F.lit(1)).cast("int"))
    # A null in the last column is a conversation that has ended; level 0 is the node before,
    # which its own block has counted, unless it is the root.
    nodes = nodes.withColumn("last", F.when(F.col("level") > 0, last))
    nodes = nodes.filter("(level > 0 and last is not null) or (level = 0 and block = 0)")
    k1, k2 = block_key(F.col("block"), names)
    above = [F.when(F.col("level") > i + 1, F.col(t)).alias(t) for i, t in enumerate(names)]
    rest = [c for c in nodes.columns if c not in names]
    chars = [F.coalesce(F.col(f"{t}.chars"), F.lit(0)) for t in names]
    nodes = nodes.select(
        *rest,
        F.col("p1").bitwiseXOR(k1).alias("k1"),
        F.col("p2").bitwiseXOR(k2).alias("k2"),
        (F.col("before") + sum(chars, F.lit(0).cast("long"))).alias("chars_to"),
        *above,
    )
    u1, u2 = block_key(F.col("block"), names)
    level = F.col("level")
    depth = (F.col("block") * width + level).cast("long")
    own = F.coalesce(F.col("last.chars"), F.lit(0).cast("long"))
    return nodes.select(
        depth.alias("depth"),
        "k1",
        "k2",
        F.col("p1").bitwiseXOR(u1).alias("u1"),
        F.col("p2").bitwiseXOR(u2).alias("u2"),
        own.alias("chars"),
        (F.col("chars_to") - own).alias("chars_above"),
        *[c for c in rest if c not in {*keys, "rolled", "level", "last"}],
    )


def _digests(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's chunks, which come one node after the other and in order."""
    schema = "depth long, k1 long, k2 long, ends_sha256 string"
    node, digest = None, None
    for batch in chunks:
        done = []
        names = ("depth", "k1", "k2", "ids")
        for *key, ids in zip(*[batch.column(name).to_pylist() for name in names]):
            if key != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield batch_of(done, schema)
    if node is not None:
        yield batch_of([(*node, digest.hexdigest())], schema)


def ends(blocks: DataFrame, width: int = WIDTH, bits: int = CHUNK_BITS) -> DataFrame:
    """Per node the digest of the ids of the conversations that end there, comma-joined."""
    names = [f"t{i + 1}" for i in range(width)]
    k1, k2 = block_key(F.col("block"), names)
    # The last block of a conversation holds its end.
    last = blocks.filter(
        F.col("block") == F.expr(f"greatest(turns - 1, 0) div {width}")
    ).select(
        F.col("turns").cast("long").alias("depth"),
        F.col("p1").bitwiseXOR(k1).alias("k1"),
        F.col("p2").bitwiseXOR(k2).alias("k2"),
        "conv_id",
        F.shiftright("conv_id", bits).alias("chunk"),
    )
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = last.groupBy(*NODE, "chunk").agg(F.array_join(ids, ",").alias("ids"))
    # First shuffled by node and chunk, then only the chunks by node.
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return ordered.select(*NODE, "ids").mapInArrow(
        _digests, "depth long, k1 long, k2 long, ends_sha256 string"
    )


def trie(turns: DataFrame, width: int = WIDTH, bits: int = CHUNK_BITS) -> DataFrame:
    """A row per node of the prefix trie over ``turns`` (as ``turn_rows`` returns them)."""
    blocks = checkpoint_stage(blocks_of(turns, width))
    names = [f"t{i + 1}" for i in range(width)]
    found = rolled_up(blocks, "min(conv_id) AS conv_id, max(turns) AS longest", width)
    childless = F.col("depth") == F.col("longest")
    standing = found.groupBy("conv_id").agg(
        F.min("depth").alias("first_depth"), F.max(childless.cast("int")).alias("leaf")
    )
    # Characters of a conversation above the depth from which it is the smallest member.
    place = [F.col("block") * width + i + 1 < F.col("first_depth") for i in range(width)]
    counted = [
        F.when(p | F.col("first_depth").isNull(), F.coalesce(F.col(f"{t}.chars"), F.lit(0))).otherwise(0)
        for p, t in zip(place, names)
    ]
    of = Window.partitionBy("conv_id")
    marked = blocks.join(standing, "conv_id", "left").select(
        *blocks.columns,
        F.sum(sum(counted, F.lit(0).cast("long"))).over(of).alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    nodes = checkpoint_stage(
        rolled_up(
            marked,
            "min(conv_id) AS conv_id, count(*) AS n_convs, sum(leaf) AS n_leaves, "
            "sum(shared) AS shared, min_by(shared, conv_id) AS own_shared",
            width,
        )
    )
    up = [F.col("u1").alias("k1"), F.col("u2").alias("k2")]
    below = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), *up)
    children = below.groupBy(*NODE).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("u1"),
        F.col("k2").alias("u2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    saved = F.col("shared") - F.col("own_shared") - F.col("chars_above") * (F.col("n_convs") - 1)
    linked = checkpoint_stage(nodes.join(parents, ["depth", "u1", "u2"], "left"))
    return (
        linked.join(children, list(NODE), "left")
        .join(ends(blocks, width, bits), list(NODE), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_leaves").cast("long").alias("n_leaves"),
            saved.cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The query's rows: the trie of the conversations with shared starts."""
    turns = checkpoint_stage(turn_rows(conversations))
    return trie(shared_starts(turns))
