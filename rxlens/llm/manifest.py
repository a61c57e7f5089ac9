"""Merkle manifest of a dataset: a digest tree per group, a root over all groups, a proof per row.

A row's leaf is the SHA-256 of its columns, each written as byte count, ``:`` and value (``-``
for null), so that no two rows share a text by accident. Leaves of a group ascend by id; every
``ARITY`` consecutive nodes become the digest of their hex digests joined, until one node is
left, the group's subroot; a lone leaf is its own. Subroots, ordered by group (null first, then
bytewise), are joined up to the root in the same way.

Each level is one equijoin. Every node names the indices of its siblings (the other slots of
its run) and meets them by index; that gives each node the digests before and after its own.
The rows in slot zero then emit the parents, whose level is the next. On the way back each
parent hands its own siblings down, so that a leaf ends up with the whole path to the root. A
proof is checked by folding a leaf, maybe an altered one, along that path.

No group gathers in one task, a hot group neither: indices come from a distributed sort (rows
are numbered within range partitions, and small counts per partition say where each begins),
and all joins are by group and index. A level has an eighth of the rows of the one below; each
is written, so a lost executor costs no earlier level. All on columns.

Defined results: null and empty values differ; repeated rows, and rows of one id with other
values, are leaves of their own, ordered by id (null first) and then by digest; a null id is
never tampered with; an empty table has no rows and no root. Columns that are not named do not
enter, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.operators.reuse import checkpoint_stage

ARITY = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows whose position takes up 33 bits, as ``monotonically_increasing_id`` lays them out.
ROW_BITS = 33


def encoded(value: Column) -> Column:
    """A value with its length before it; nulls differ from every text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    """Only A-Z change."""
    return F.translate(text.cast("string"), UPPER, UPPER.lower())


def every_third(doc_id: Column) -> Column:
    """Rows that the check tampers with: 3 divides the CRC of the id in decimal."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def group_key(group: Column) -> Column:
    """A text that sorts like the group, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def indexed(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``idx`` (0, 1, ... within the group) and ``n``, the size of the group.

    One sort by range of group and order; equal keys may lie in several partitions, as a row's
    own place is the last key. Rows are numbered inside their partition, and a table of
    partitions and groups says at which index each of them begins.
    """
    keys = [group, *order]
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    spread = placed.repartitionByRange(*keys, "__place").sortWithinPartitions(*keys).drop("__place")
    rows = checkpoint_stage(spread.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", ROW_BITS)
    runs = rows.groupBy(group, part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__rows")
    )
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group,
        "__part",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(Window.partitionBy(group)).alias("n"),
    )
    joined = rows.withColumn("__part", part).join(starts, [group, "__part"])
    return joined.withColumn("idx", F.col("__at") + F.col("__shift")).drop(
        "__at", "__part", "__shift"
    )


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes with ``left`` and ``right``: the digests of their run before and after them.

    ``nodes``: ``tree``, ``idx``, ``n`` (nodes of the tree on this level) and ``digest``; other
    columns are carried. Every node offers its digest to the indices of its siblings, at most
    ``arity - 1`` of them, and is joined with what it is offered.
    """
    slot = F.col("idx") % arity
    run = F.col("idx") - slot
    shifts = F.array(*[F.lit(i) for i in range(1, arity)])
    offered = nodes.select(
        "tree", "n", slot.alias("from"), "digest", run.alias("run"), F.explode(shifts).alias("shift")
    ).select(
        F.col("tree").alias("__tree"),
        (F.col("run") + (F.col("from") + F.col("shift")) % arity).alias("__idx"),
        "n",
        F.col("from").alias("__from"),
        F.col("digest").alias("__digest"),
    )
    offered = offered.filter("__idx < n").drop("n")
    met = nodes.join(
        offered, (F.col("tree") == F.col("__tree")) & (F.col("idx") == F.col("__idx")), "left"
    )
    carried = [c for c in nodes.columns if c not in ("tree", "idx")]
    one_of = [
        F.max(F.when(F.col("__from") == i, F.col("__digest"))).alias(f"__s{i}") for i in range(arity)
    ]
    wide = met.groupBy("tree", "idx").agg(*[F.max(c).alias(c) for c in carried], *one_of)
    # Its own slot is empty, so a node's siblings part at it.
    sides = [[F.when(slot > i, F.col(f"__s{i}")) for i in range(arity)]]
    sides.append([F.when(slot < i, F.col(f"__s{i}")) for i in range(arity)])
    left, right = (F.concat_ws("", *side) for side in sides)
    return wide.select("tree", "idx", *carried, left.alias("left"), right.alias("right"))


def parents_of(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level: the rows in slot zero speak for their run."""
    return level.filter(F.col("idx") % arity == 0).select(
        "tree",
        F.expr(f"idx div {arity}").alias("idx"),
        F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        F.sha2(F.concat("digest", "right"), 256).alias("digest"),
    )


@dataclass(frozen=True)
class Forest:
    """Trees that grew side by side. ``levels`` hold nodes with their siblings, lowest first;
    ``tops`` one node per tree: ``tree``, ``level`` and ``digest``."""

    levels: list[DataFrame]
    tops: DataFrame
    arity: int


def grow(leaves: DataFrame, arity: int = ARITY) -> Forest:
    """Join nodes upwards until every tree has one. Extra columns of the leaves stay below."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes, tops, level = [], leaves, None, 0
    while True:
        top = nodes.filter("n = 1").select("tree", F.lit(level).alias("level"), "digest")
        tops = top if tops is None else tops.union(top)
        if most <= 1:
            return Forest(levels, checkpoint_stage(tops), arity)
        levels.append(checkpoint_stage(with_siblings(nodes.filter("n > 1"), arity)))
        nodes = parents_of(levels[-1], arity)
        most = -(-most // arity)
        level += 1


def paths(forest: Forest, above: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Add to leaves of the forest their ``path`` to the root.

    ``above``: ``tree``, ``path`` (from the tree's top node upwards) and ``subroot``. A path is
    a list of what stands before and after the node on each level. Returns a function, for the
    last step is a join with the leaves themselves.
    """
    tops = forest.tops.join(above, "tree").select(
        "tree", F.lit(0).cast("long").alias("idx"), "level", "path", "subroot"
    )
    down = None
    for level in reversed(range(len(forest.levels) + 1)):
        here = tops.filter(F.col("level") == level).drop("level")
        if down is not None:
            nodes = forest.levels[level].select("tree", "idx", "left", "right")
            here = here.union(_handed_down(nodes, down, forest.arity))
        if level == 0:
            break
        down = checkpoint_stage(here)
    if down is None:
        return lambda leaves: leaves.join(tops.drop("level"), ["tree", "idx"])

    def finish(leaves: DataFrame) -> DataFrame:
        """``leaves`` carry what ``Forest.levels[0]`` carries, or are lone."""
        alone = leaves.filter("n = 1").join(tops.filter("level = 0").drop("level", "idx"), "tree")
        low = _handed_down(forest.levels[0], down, forest.arity)
        names = [*leaves.columns, "path", "subroot"]
        return low.select(*names).union(alone.select(*names))

    return finish


def _handed_down(nodes: DataFrame, parents: DataFrame, arity: int) -> DataFrame:
    up = parents.select(
        "tree", F.col("idx").alias("__parent"), F.col("path").alias("__path"), "subroot"
    )
    step = F.struct("left", "right")
    joined = nodes.withColumn("__parent", F.expr(f"idx div {arity}")).join(up, ["tree", "__parent"])
    rest = [c for c in nodes.columns if c not in ("left", "right")]
    return joined.select(*rest, F.concat(F.array(step), "__path").alias("path"), "subroot")


def proof_text(path: Column) -> Column:
    """All siblings from the leaf's run upwards, joined."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(
        path, leaf, lambda digest, p: F.sha2(F.concat(p["left"], digest, p["right"]), 256)
    )


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    changed: Callable[[DataFrame], DataFrame] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """``order``, ``leaf``, ``subroot``, ``root``, ``path``, ``proof_sha256``, ``folded_root`` and
    ``verified`` of every row.

    ``changed`` maps the named columns to what a verifier reads later; without it the rows are
    verified as they are.
    """
    named = docs.select(*[F.col(f"`{c}`") for c in columns])
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    marked = named.withColumn("__leaf", leaf).withColumn("__group", group_key(F.col(f"`{group}`")))
    later = changed(marked) if changed else marked
    # Texts are read once; from here on a row is a few digests.
    rows = checkpoint_stage(
        later.select(
            F.col("__group").alias("tree"),
            F.col(f"`{order}`").cast("long").alias("id"),
            F.col("__leaf").alias("digest"),
            F.sha2(F.concat(*[encoded(F.col(f"`{c}`")) for c in columns]), 256).alias("read"),
        )
    )
    leaves = checkpoint_stage(indexed(rows, "tree", ["id", "digest"]))
    trees = grow(leaves, arity)
    subroots = trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    subroots = checkpoint_stage(indexed(subroots, "tree", ["group"]))
    whole = grow(subroots, arity)
    root = whole.tops.select("digest").first()
    over = whole.tops.select(
        "tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
        F.lit("").alias("subroot"),
    )
    above = paths(whole, over)(subroots).select(
        F.col("group").alias("tree"), "path", F.col("digest").alias("subroot")
    )
    found = paths(trees, checkpoint_stage(above))(leaves)
    root_text = F.lit(root[0] if root else None).cast("string")
    again = folded(F.col("read"), F.col("path"))
    return found.select(
        F.col("id").alias(order),
        F.col("digest").alias("leaf"),
        "subroot",
        root_text.alias("root"),
        "path",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame) -> DataFrame:
    """Texts in lower case for a third of the ids."""
    hit = every_third(F.col("doc_id"))
    return docs.withColumn("text", F.when(hit, lowered(F.col("text"))).otherwise(F.col("text")))


def manifest_report(docs: DataFrame) -> DataFrame:
    """The query's rows."""
    return manifest(docs, changed=tampered).drop("path")
