"""Windows over periods.

These operators work on period tables: one row per ``by`` key and period, as ``monthly``
makes them. Such a table is small however many claims lie behind it, so a window without
``by`` may run in one task, and a window with ``by`` never sees more rows per key than
there are periods. Do not feed raw claims to them; aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rxlens.functions import cents, dollars, growth, month_index, rate_pct


def _periods(order: str, by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def prior_value(
    order: str, col: str, n: int, by: Sequence[str] = (), calendar: bool = False
) -> Column:
    """Value ``n`` rows back, or with ``calendar`` exactly ``n`` months back.

    The two differ when a month is missing: the calendar form then gives NULL, the row
    form the value of another month.
    """
    if not calendar:
        return F.lag(col, n).over(_periods(order, by))
    by_month = Window.partitionBy(*by).orderBy(month_index(order)).rangeBetween(-n, -n)
    return F.max(col).over(by_month)


def with_lag(
    df: DataFrame,
    order: str,
    col: str,
    n: int = 1,
    by: Sequence[str] = (),
    name: str | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Add the value of an earlier period."""
    return df.withColumn(name or f"{col}_lag_{n}", prior_value(order, col, n, by, calendar))


def with_lead(
    df: DataFrame,
    order: str,
    col: str,
    n: int = 1,
    by: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """Add the value of a later row."""
    ahead = F.lead(col, n).over(_periods(order, by))
    return df.withColumn(name or f"{col}_lead_{n}", ahead)


def growth_pct(
    df: DataFrame,
    order: str,
    col: str,
    n: int = 1,
    by: Sequence[str] = (),
    name: str = "growth_pct",
    calendar: bool = False,
) -> DataFrame:
    """Add the percent change against an earlier period; NULL without or after a zero."""
    return df.withColumn(name, growth(col, prior_value(order, col, n, by, calendar)))


def moving_avg(
    df: DataFrame,
    order: str,
    col: str,
    k: int,
    by: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """Add the mean of a money column over ``k`` rows; the first rows average what is there."""
    frame = _periods(order, by).rowsBetween(1 - k, 0)
    whole = cents(col)
    mean = F.sum(whole).over(frame) / (F.count(whole).over(frame) * 100)
    return df.withColumn(name or f"moving_avg_{k}", F.round(mean, 2))


def running_total(
    df: DataFrame, order: str, col: str, by: Sequence[str] = (), name: str = "running_total"
) -> DataFrame:
    """Add the sum of a money column from the first row to this one."""
    frame = _periods(order, by).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, dollars(F.sum(cents(col)).over(frame)))


def share_pct(
    df: DataFrame, measure: Column | str, by: Sequence[str], name: str = "share_pct"
) -> DataFrame:
    """Add each row's percentage of the total of its ``by`` group.

    ``measure`` should be a whole number (a count, or cents): the total is then exact.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    total = F.sum(measure).over(Window.partitionBy(*by))
    return df.withColumn(name, rate_pct(measure, total))


def share_shift(
    df: DataFrame,
    month: str,
    category: str,
    measure: Column | str,
    share: str = "share_pct",
    shift: str = "share_shift",
) -> DataFrame:
    """Add each category's share of its month and the change since the category's last month."""
    shared = share_pct(df, measure, [month], share)
    before = prior_value(month, share, 1, [category])
    return shared.withColumn(shift, F.round(F.col(share) - before, 2))


def flag_anomalies(
    df: DataFrame,
    order: str,
    col: str,
    by: Sequence[str] = (),
    window: int = 6,
    z: float = 3.0,
) -> DataFrame:
    """Add mean, deviation and z-score against the ``window`` rows before, and a flag.

    Without two earlier rows, or when they do not vary, there is no score and no flag.
    """
    past = _periods(order, by).rowsBetween(-window, -1)
    scored = df.withColumns(
        {
            "past_mean": F.round(F.avg(col).over(past), 4),
            "past_stddev": F.round(F.stddev_samp(col).over(past), 4),
        }
    )
    score = F.try_divide(F.col(col) - F.col("past_mean"), F.col("past_stddev"))
    return scored.withColumn("z_score", F.round(score, 4)).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > z, F.lit(False))
    )
