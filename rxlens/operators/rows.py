"""Row-level operators: append, type, keep the best row, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def append_all(*frames: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def align_and_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of two feed versions; a column that one of them lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not parse becomes NULL instead of an error.

    ``try_cast`` reads text only when it is asked for a number or a date of it, so a
    column that already has the type passes through unchanged.
    """
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def dedup_best(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first by ``order_by``.

    The ``row_number() = 1`` filter sits next to its window, so Spark keeps one row per
    key and map task before the shuffle. A key with very many copies therefore sends at
    most one row per task. Give enough order columns to break ties.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def top_k(df: DataFrame, k: int, order: Sequence[Column | str], tie: Sequence[str]) -> DataFrame:
    """The first ``k`` rows by ``order``, then by ``tie``, which must make it total.

    Sort and limit stay in one plan, so each task keeps only its own first ``k`` rows.
    """
    return df.orderBy(*order, *tie).limit(k)
