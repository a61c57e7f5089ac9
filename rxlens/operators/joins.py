"""Joins and lookups.

Joins carry no broadcast hint of their own: Spark broadcasts a side whose size it knows
to be under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where
adaptive execution splits a partition that one hot key fills. ``broadcast_if_small`` is
for a caller who wants a higher limit than the session's, still behind a size check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size Spark's optimizer expects; the default for unknown sizes is very large."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the estimate is within the limit, else leave ``df`` alone."""
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def lookup(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str], value: str, default: object
) -> DataFrame:
    """Add ``value`` from a code table; rows without a match get ``default``.

    The code table is reduced to one row per key first, so rows never multiply, and is
    broadcast if it is small.
    """
    keys = [on] if isinstance(on, str) else list(on)
    codes = dim.groupBy(*keys).agg(F.min(value).alias(value))
    return join_default(df, broadcast_if_small(codes), keys, {value: default})


def join_default(
    df: DataFrame, other: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join in which NULLs of the named columns become their defaults."""
    joined = df.join(other, on, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row table to each row.

    A scalar subquery does it: Spark runs the one-row plan once, puts the result into the
    expression and raises if a second row ever turns up. There is no join to plan.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("packed")).scalar()
    widened = df.withColumn("__scalars", packed)
    names = [F.col("__scalars")[name].alias(name) for name in one_row.columns]
    return widened.select(*[F.col(name) for name in df.columns], *names)


def in_subquery(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (``IN (SELECT ...)``).

    The keys are made distinct, and so combined within map tasks, before they move.
    """
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*names).distinct(), names, "left_semi")


def members_in_plan(claims: DataFrame, members: DataFrame, plan_id: str) -> DataFrame:
    """Claims of the members of one line of business."""
    chosen = members.where(F.col("plan_id") == plan_id).select("member_id")
    return in_subquery(claims, chosen, "member_id")


def drug_lines(claims: DataFrame, procedures: DataFrame, members: DataFrame) -> DataFrame:
    """Drug line items with the member of their claim; lines without either drop out."""
    people = members.select("member_id", "gender", "birth_date", F.col("plan_id").alias("lob"))
    headers = claims.select("claim_id", "member_id")
    return headers.join(procedures, "claim_id").join(people, "member_id")


def with_lob(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Claims with the line of business and effective date of their member."""
    dim = members.select("member_id", F.col("plan_id").alias("lob"), "effective_date")
    return claims.join(dim, "member_id")


def claims_enriched(claims: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """Wide claims: member and pharmacy attributes beside every claim, none lost."""
    member_dim = members.select(
        "member_id", "gender", "birth_date", F.col("plan_id").alias("lob"), "effective_date"
    )
    provider_dim = providers.select(
        "provider_id", "provider_name", F.col("specialty").alias("channel"), "state"
    )
    return claims.join(member_dim, "member_id", "left").join(provider_dim, "provider_id", "left")


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Compare the totals of two sources, key by key.

    Both sides are aggregated before they meet, so only one row per key and side moves
    into the full outer join. A measure is an aggregate Column; the result holds
    ``<name>_left``, ``<name>_right``, ``<name>_diff`` (a missing side counts as zero)
    and ``matches``. NULL keys meet each other.
    """
    sides = []
    for df, tag in ((left, "left"), (right, "right")):
        totals = [column.alias(f"{name}_{tag}") for name, column in measures.items()]
        sides.append(df.groupBy(*keys).agg(*totals).alias(tag))
    same_key = None
    for key in keys:
        pair = F.col(f"left.{key}").eqNullSafe(F.col(f"right.{key}"))
        same_key = pair if same_key is None else same_key & pair
    out = [F.coalesce(F.col(f"left.{key}"), F.col(f"right.{key}")).alias(key) for key in keys]
    all_match = F.lit(True)
    for name in measures:
        ours, theirs = F.col(f"{name}_left"), F.col(f"{name}_right")
        gap = F.coalesce(ours, F.lit(0)) - F.coalesce(theirs, F.lit(0))
        out += [ours, theirs, gap.alias(f"{name}_diff")]
        all_match = all_match & ours.eqNullSafe(theirs)
    return sides[0].join(sides[1], same_key, "full_outer").select(
        *out, all_match.alias("matches")
    )
