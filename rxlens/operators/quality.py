"""Data-quality checks. A rule is a named Column that is true for a *bad* row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlens.functions import as_date, month_boundaries
from rxlens.operators.rows import append_all

VIOLATIONS = "violated_rules"


def claim_rules(as_of: dt.date | str) -> dict[str, Column]:
    """The standing rules for claims: no id, a negative charge, a date after ``as_of``."""
    return {
        "null_claim_ids": F.col("claim_id").isNull(),
        "negative_charges": F.col("total_charge") < 0,
        "future_dates": F.col("claim_date") > as_date(as_of),
    }


def dq_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the rows that break it, all counted in a single pass."""
    counted = df.agg(
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()],
        F.count(F.lit(1)).alias("__checked"),
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    )
    return counted.select(F.explode(pairs).alias("pair"), "__checked").select(
        "pair.rule", "pair.violations", F.col("__checked").alias("rows_checked")
    )


def tag_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the list of broken rules to every row; empty for a valid row."""
    broken = [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    return df.withColumn(VIOLATIONS, F.array_compact(F.array(*broken)))


def enforce(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows, rejected rows with their reasons).

    Each half scans the input. To write both in one pass, write ``tag_violations``
    partitioned by whether the list is empty.
    """
    tagged = tag_violations(df, rules)
    valid = F.size(VIOLATIONS) == 0
    return tagged.where(valid).drop(VIOLATIONS), tagged.where(~valid)


def orphans(df: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is missing from ``parent``, NULL keys included."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(parent.select(*keys).distinct(), keys, "left_anti")


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each stage, in one job."""
    return append_all(
        *[
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("stage"), "row_count"
            )
            for name, df in stages.items()
        ]
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action (a write) runs, without a second pass.

    Read ``observation.get["row_count"]`` after the action.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


Drift = tuple[str, str, str | None, str | None]


def schema_drift(old: T.StructType, new: T.StructType) -> list[Drift]:
    """Columns (change, name, old type, new type) that a feed gained, lost, retyped or moved."""
    before = {field.name: field.dataType.simpleString() for field in old}
    after = {field.name: field.dataType.simpleString() for field in new}
    drift: list[Drift] = []
    drift += [("lost", name, kind, None) for name, kind in before.items() if name not in after]
    drift += [("added", name, None, kind) for name, kind in after.items() if name not in before]
    kept = [name for name in before if name in after]
    drift += [
        ("retyped", name, before[name], after[name]) for name in kept if before[name] != after[name]
    ]
    kept_after = [name for name in after if name in before]
    drift += [
        ("moved", was, before[was], after[was])
        for was, now in zip(kept, kept_after)
        if was != now
    ]
    return drift


def mark_immature(
    df: DataFrame, month_col: str, as_of: dt.date | str, lag_months: int
) -> DataFrame:
    """Flag months too recent to be complete: fewer than ``lag_months`` before ``as_of``."""
    age = month_boundaries(month_col, as_date(as_of))
    return df.withColumn("is_immature", age < lag_months)
