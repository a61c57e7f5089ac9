"""Table maintenance as DataFrame operators.

Plain Parquet tables know no MERGE, UPDATE, DELETE or time travel, so each of these
returns the new state of the table. Write that to a new path and swap; never overwrite
the files a plan still reads. There is one writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.operators.rows import dedup_best

CHANGE = "_change"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New state after source rows replace target rows of equal key, or are added.

    Target rows whose key the source lacks are kept by an anti join against the bare
    source keys, so a small batch is broadcast and a large target never shuffles. NULL
    keys match nothing. A key that occurs twice in the source raises.
    """
    names = list(keys)
    source_keys = source.select(*names).dropna(subset=names).distinct()
    untouched = target.join(source_keys, names, "left_anti").select(*target.columns)
    # The check rides on the rows that are returned, so no target can make it drop out.
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    twice = F.raise_error(F.lit(f"upsert: duplicate source key in {names}")).cast("boolean")
    turn = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    checked = source.where(known).withColumn("__turn", turn)
    once = checked.where(F.when(F.col("__turn") > 1, twice).otherwise(F.lit(True)))
    added = once.drop("__turn").unionByName(source.where(~known))
    return untouched.unionByName(added)


def update_where(df: DataFrame, cond: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet ``cond``; all other rows stay as they are."""
    return df.withColumns(
        {name: F.when(cond, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop the rows that meet ``cond``; a row where it is NULL stays."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes that lead from one state to the next, labelled in ``_change``.

    An update yields its row before and after. Keys must be unique within a state;
    values compare null-safely.
    """
    columns = old.columns
    rest = [name for name in columns if name not in keys]
    same_key = None
    for key in keys:
        pair = F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}"))
        same_key = pair if same_key is None else same_key & pair
    both = (
        old.select("*", F.lit(True).alias("__here"))
        .alias("o")
        .join(
            new.select(*columns, F.lit(True).alias("__here")).alias("n"), same_key, "full_outer"
        )
    )
    changed = F.lit(False)
    for name in rest:
        changed = changed | ~F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))

    def row(side: str, change: str) -> Column:
        fields = [F.col(f"{side}.{name}").alias(name) for name in columns]
        return F.struct(F.lit(change).alias(CHANGE), *fields)

    changes = (
        F.when(F.col("o.__here").isNull(), F.array(row("n", "insert")))
        .when(F.col("n.__here").isNull(), F.array(row("o", "delete")))
        .when(changed, F.array(row("o", "update_pre"), row("n", "update_post")))
    )
    return both.select(F.explode(changes).alias("row")).select(
        *[F.col("row")[name].alias(name) for name in columns], F.col("row")[CHANGE].alias(CHANGE)
    )


def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after a change feed.

    The feed is read twice; stage one that is expensive to work out. When it is small the
    state does not shuffle.
    """
    written = changes.where(F.col(CHANGE).isin("insert", "update_post"))
    touched = changes.where(F.col(CHANGE) != "update_pre").select(*keys).distinct()
    same_key = None
    for key in keys:
        pair = F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}"))
        same_key = pair if same_key is None else same_key & pair
    kept = state.alias("s").join(touched.alias("t"), same_key, "left_anti")
    return kept.select(*state.columns).unionByName(written.select(*state.columns))


def apply_history(
    history: DataFrame, changes: DataFrame, batch_ts: dt.datetime | dt.date, ts_col: str = "batch_ts"
) -> DataFrame:
    """History with one more batch; applying a batch again replaces it."""
    stamp = F.lit(batch_ts).cast(history.schema[ts_col].dataType)
    others = history.where(~F.col(ts_col).eqNullSafe(stamp))
    return others.unionByName(changes.withColumn(ts_col, stamp), allowMissingColumns=True)


def as_of(
    history: DataFrame, keys: Sequence[str], ts_col: str, ts: dt.datetime | dt.date | str
) -> DataFrame:
    """Table state at a time: the last row per key up to then, deleted keys left out.

    The time filter reaches the scan, and prunes files when history is partitioned by
    ``ts_col``. The row before an update and the row after share a batch, so the former
    does not count.
    """
    past = history.where(F.col(ts_col) <= F.lit(ts).cast(history.schema[ts_col].dataType))
    if CHANGE not in history.columns:
        return dedup_best(past, keys, [F.desc(ts_col)])
    past = past.where(F.col(CHANGE) != "update_pre")
    latest = dedup_best(past, keys, [F.desc(ts_col), F.asc(CHANGE)])
    return latest.where(F.col(CHANGE) != "delete").drop(CHANGE)
