"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into ``2 ** BITS`` steps with near-equal numbers of rows; a row's cell is
its place on the Hilbert curve through these steps. Rows sorted by cell are cut into runs of
equal length, one per shard, so a shard covers a compact box of all dimensions and a filter on
any of them skips most shards. Law: ``rows`` (row counts differ by one at most).

No global sort is needed. Cells are counted, crowded cells are split further by a hash of the
row, and a row's rank is the number of rows in all parts before its own (a running total over
the small table of parts) plus its place in its part. A cell that holds a third of all rows is
ranked by as many tasks as it has parts.

All on columns: no Python on the executors. Texts are not shuffled, only their sizes.

Defined results: a null dimension lies on the first step; a null text has size 16 and the CRC
of no bytes; rows with equal values are ranked by id, the order of fully equal rows does not
show; equal values of a dimension share a step, texts are compared whole; with fewer rows than
shards some shards are empty. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.operators.reuse import checkpoint_stage

SHARDS = 40
BITS = 5
PART_ROWS = 20_000
OVERHEAD = 16
NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"}


def _rotate(value: Column, by: Column, dims: int, left: bool) -> Column:
    """Rotate the lowest ``dims`` bits."""
    by = by % dims
    back = (F.lit(dims) - by) % dims
    a, b = (by, back) if left else (back, by)
    up = F.call_function("shiftleft", value, a)
    down = F.call_function("shiftright", value, b)
    turned = up.bitwiseOR(down).bitwiseAND((1 << dims) - 1)
    return F.when(by == 0, value).otherwise(turned)


def hilbert(steps: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell, given its step (0 to 2**bits - 1) per dimension.

    From the highest bit down, the bits of all dimensions name one of ``2 ** dims`` sub-cubes.
    The curve enters the present cube at corner ``e`` and leaves along axis ``d``; turned into
    that frame, sub-cubes are visited in Gray code order.
    """
    dims = len(steps)
    size = 1 << dims
    gray = [i ^ (i >> 1) for i in range(size)]
    visit = [gray.index(i) for i in range(size)]
    # Corner where the curve enters sub-cube i, and the axis along which it crosses it.
    enter = [0] + [gray[2 * ((i - 1) // 2)] for i in range(1, size)]
    low_ones = [(~i & (i + 1)).bit_length() - 1 for i in range(size)]
    axis = [0] + [(low_ones[i - 1] if i % 2 == 0 else low_ones[i]) % dims for i in range(1, size)]
    visit_of, enter_of, axis_of = (F.array(*map(F.lit, x)) for x in (visit, enter, axis))

    def at(state: Column, level: Column) -> Column:
        here = F.lit(0)
        for i, step in enumerate(steps):
            bit = F.call_function("shiftright", step.cast("int"), level).bitwiseAND(1)
            here = here.bitwiseOR(F.call_function("shiftleft", bit, F.lit(i)))
        label = _rotate(here.bitwiseXOR(state["e"]), state["d"] + 1, dims, left=False)
        w = F.element_at(visit_of, label + 1)
        e = state["e"].bitwiseXOR(
            _rotate(F.element_at(enter_of, w + 1), state["d"] + 1, dims, left=True)
        )
        d = (state["d"] + F.element_at(axis_of, w + 1) + 1) % dims
        place = (state["place"] * size + w).cast("long")
        return F.struct(place.alias("place"), e.alias("e"), d.alias("d"))

    start = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, at, lambda state: state["place"])


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, and a fixed overhead per row."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + OVERHEAD


def _runs(values: DataFrame, bits: int) -> list[tuple[object, int]]:
    """Smallest value and step of every step that a text dimension fills.

    A value's step is the share of rows that sort before it. Values are counted first; the
    distinct ones are sorted by range, so neither many values nor a common prefix matters.
    """
    counts = values.groupBy("value").agg(F.count("*").alias("rows"))
    spread = counts.repartitionByRange("value").sortWithinPartitions("value")
    kept = checkpoint_stage(spread.withColumn("part", F.spark_partition_id()))
    parts = kept.groupBy("part").agg(F.sum("rows").alias("part_rows"))
    # One row per partition of the sort.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("base"))
    total = kept.agg(F.sum("rows")).first()[0] or 1
    smaller = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("rows").over(smaller), F.lit(0))
    placed = kept.withColumn("inner", inner).join(parts, "part").filter("value is not null")
    step = F.expr(f"cast((cast(base + inner as decimal(38, 0)) * {1 << bits}) div {total} as int)")
    firsts = placed.groupBy(step.alias("step")).agg(F.min("value").alias("value"))
    return sorted((r["value"], r["step"]) for r in firsts.collect())


def _step(value: Column, firsts: list[tuple[object, int]]) -> Column:
    """The step of the largest of ``firsts`` that is not above the value."""
    if not firsts:
        return F.lit(0)
    known = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(n).alias("step")) for v, n in firsts])
    passed = F.filter(known, lambda first: first["value"] <= value)
    return F.coalesce(F.get(passed, F.size(passed) - 1)["step"], F.lit(0))


def quantised(docs: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``docs`` with a step ``__step0``, ``__step1`` … per column, cut at quantiles.

    Numbers are cut at approximate quantiles, all else by its text, whole and bytewise. The
    cuts are at most ``2 ** bits`` values per column, whatever the size of the input.
    """
    kinds = dict(docs.dtypes)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numeric = [c for c in columns if kinds[c].split("(")[0] in NUMBERS]
    cuts = {}
    if numeric:
        found = docs.agg(
            *[
                F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 1000).alias(f"q{i}")
                for i, c in enumerate(numeric)
            ]
        ).first()
        cuts = {c: [float(x) for x in found[k] or []] for k, c in enumerate(numeric)}
    steps = {}
    for i, c in enumerate(columns):
        if c in cuts:
            value = F.col(f"`{c}`").cast("double")
            known = F.array(*map(F.lit, cuts[c])).cast("array<double>")
            steps[f"__step{i}"] = F.size(F.filter(known, _below(value)))
        else:
            value = F.col(f"`{c}`").cast("string")
            steps[f"__step{i}"] = _step(value, _runs(docs.select(value.alias("value")), bits))
        steps[f"__step{i}"] = F.when(value.isNull(), 0).otherwise(steps[f"__step{i}"]).cast("int")
    return docs.withColumns(steps)


def _below(value: Column) -> Callable[[Column], Column]:
    # A lambda with a second parameter would be given the position in the list.
    return lambda cut: cut < value


def shard(
    docs: DataFrame,
    columns: Sequence[str] = ("source", "lang", "n_chars"),
    shards: int = SHARDS,
    bits: int = BITS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``cell``, ``shard`` and ``slot`` of every row."""
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"__d{i}") for i, c in enumerate(columns)],
        F.col("doc_id").cast("long").alias("doc_id"),
        text_size(F.col("text").cast("string")).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
    )
    rows = quantised(rows, [f"__d{i}" for i in range(len(columns))], bits)
    cell = hilbert([F.col(f"__step{i}") for i in range(len(columns))], bits)
    spot = F.xxhash64("doc_id", "text_crc32", "size")
    rows = checkpoint_stage(
        rows.select("doc_id", "size", "text_crc32", cell.alias("cell"), spot.alias("spot"))
    )
    # At most 2 ** (bits * dims) cells; a crowded one is cut into parts by hash.
    cells = rows.groupBy("cell").agg(F.count("*").alias("rows"))
    parts_of = F.ceil(F.col("rows") / part_rows).cast("long")
    many = cells.filter(F.col("rows") > part_rows).select("cell", parts_of.alias("parts"))
    part = F.coalesce(F.pmod(F.col("spot"), F.col("parts")), F.lit(0))
    placed = checkpoint_stage(
        rows.join(F.broadcast(many), "cell", "left").withColumn("part", part).drop("parts")
    )
    parts = placed.groupBy("cell", "part").agg(F.count("*").alias("rows"))
    before_cell = F.sum("rows").over(
        Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    before_part = F.sum("rows").over(
        Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = parts.groupBy("cell").agg(F.sum("rows").alias("rows"))
    totals = totals.select("cell", F.coalesce(before_cell, F.lit(0)).alias("base"))
    starts = (
        parts.withColumn("inner", F.coalesce(before_part, F.lit(0)))
        .join(totals, "cell")
        .select("cell", "part", (F.col("base") + F.col("inner")).alias("start"))
    )
    total = rows.count()
    place = F.row_number().over(
        Window.partitionBy("cell", "part").orderBy("spot", "doc_id", "text_crc32", "size")
    )
    rank = F.col("start") + F.col("place") - 1
    number = F.expr(f"(__rank * {shards}) div {max(total, 1)}")
    # The first rank of shard s is the smallest r with r * shards >= s * total.
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return (
        placed.withColumn("place", place)
        .join(starts, ["cell", "part"])
        .withColumn("__rank", rank)
        .withColumn("shard", number.cast("int"))
        .withColumn("slot", (F.col("__rank") - first).cast("long"))
        .select("doc_id", "size", "text_crc32", "cell", "shard", "slot")
    )


def shard_report(docs: DataFrame) -> DataFrame:
    """The query's rows."""
    return shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )
