"""Grouped summaries, frequencies, pivots and exact percentiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.functions import first_of_month
from rxlens.operators.joins import with_scalars


def summarise(
    df: DataFrame, by: Sequence[Column | str], measures: Mapping[str, Column]
) -> DataFrame:
    """Group and aggregate; ``measures`` maps the output name to an aggregate."""
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in measures.items()])


def monthly(
    df: DataFrame,
    date_col: str,
    by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    month: str = "claim_month",
) -> DataFrame:
    """One row per month and ``by`` key. The trend operators expect input of this shape."""
    measures = measures or {"row_count": F.count(F.lit(1))}
    return summarise(df, [first_of_month(date_col).alias(month), *by], measures)


def freq(df: DataFrame, *cols: str, name: str = "frequency") -> DataFrame:
    """Rows per value, or per combination of values, most frequent first."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), *cols)


def count_when(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    values: Mapping[str, object],
    total: str = "total",
    weight: str | None = None,
) -> DataFrame:
    """Counts by value as columns, and the count of all rows.

    ``values`` maps output names to values of ``col``. With ``weight`` the rows already
    are counts, and the weight is added up instead.
    """
    unit = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    picked = {
        name: F.sum(F.when(F.col(col) == value, unit).otherwise(F.lit(0).cast("bigint")))
        for name, value in values.items()
    }
    return summarise(df, by, {**picked, total: F.sum(unit)})


def resummarise(
    df: DataFrame,
    by: Sequence[str],
    sums: Sequence[str] = (),
    averages: Sequence[str] = (),
) -> DataFrame:
    """Aggregate a summary again. An average of averages is unweighted."""
    measures = {name: F.sum(name) for name in sums}
    measures |= {name: F.avg(name) for name in averages}
    return summarise(df, by, measures)


def to_wide(
    df: DataFrame, by: Sequence[str], pivot_col: str, values: Sequence[str], measure: str
) -> DataFrame:
    """Long to wide: one column for each of the given values, holding the summed measure."""
    return df.groupBy(*by).pivot(pivot_col, list(values)).agg(F.sum(measure))


def percentiles(
    df: DataFrame,
    col: str,
    points: Mapping[str, float],
    exact: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles of a numeric column over the whole table, as one row.

    ``points`` maps output names to fractions. The result interpolates between the two
    neighbouring values, and NULLs do not count.

    Spark's own exact percentile gathers every distinct value in one task. Here a
    bounded-error sketch first brackets each wanted rank; then one aggregation counts
    rows, value by value inside the brackets and lump-sum between them. Only that small
    histogram is ranked in one task: per point at most 8 / accuracy of the rows, and no
    more than there are different amounts inside the bracket. A billion members give
    under a million rows per point; raise ``accuracy`` for more. ``exact=False`` returns
    the sketch's answer.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    if not exact:
        found = [F.percentile_approx("v", p, accuracy).alias(n) for n, p in points.items()]
        return values.agg(*found)

    margin = 4.0 / accuracy
    fractions = sorted(set(points.values()))
    lows = [max(0.0, p - margin) for p in fractions]
    highs = [min(1.0, p + margin) for p in fractions]
    sketch = values.agg(
        F.count("v").alias("n"),
        F.percentile_approx("v", lows + highs, accuracy).alias("marks"),
    )

    # Group key: (value, 0) inside a bracket, else (top of the bracket below, 1).
    # With few rows everything counts as inside.
    tops = [F.col("marks")[len(lows) + i] for i in range(len(lows))]
    inside = F.col("n") <= accuracy
    below = F.lit(None).cast("double")
    for i, top in enumerate(tops):
        inside = inside | F.col("v").between(F.col("marks")[i], top)
        below = F.when(F.col("v") > top, top).otherwise(below)
    histogram = (
        with_scalars(values, sketch)
        .groupBy(
            F.when(inside, F.col("v")).otherwise(below).alias("v"),
            F.when(inside, 0).otherwise(1).alias("lump"),
        )
        .agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"))
    )
    in_order = Window.orderBy(F.col("v").asc_nulls_first(), "lump")
    ranked = histogram.withColumn(
        "upto", F.sum("rows").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )

    out = []
    for name, p in points.items():
        position = F.lit(p) * (F.col("n") - 1)
        low, high = (_value_at(F.floor(position) + 1), _value_at(F.ceil(position) + 1))
        share = F.max(position - F.floor(position))
        out.append((low + (high - low) * share).alias(name))
    return ranked.agg(*out)


def _value_at(rank: Column) -> Column:
    """Aggregate: value of the first histogram row that reaches the rank."""
    first = F.min(F.when(F.col("upto") >= rank, F.struct("upto", "lump", "v")))
    missed = F.raise_error(F.lit("percentiles: rank outside its bracket; raise accuracy"))
    return F.when(first["lump"] == 1, missed.cast("double")).otherwise(first["v"])
