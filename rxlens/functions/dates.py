"""Calendar helpers.

Nothing here reads the clock: a pipeline takes ``as_of`` and passes it down, so that a
rerun gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxlens.functions.columns import ColumnOrName, as_column


def as_date(day: dt.date | str | Column) -> Column:
    """A date literal from a date or an ISO text; a Column passes through."""
    if isinstance(day, Column):
        return day
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return F.lit(day)


def first_of_month(day: ColumnOrName) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(as_column(day), "MM")


def month_index(day: ColumnOrName) -> Column:
    """Months counted from year 0: consecutive months differ by exactly one."""
    day = as_column(day)
    return F.year(day) * 12 + F.month(day)


def month_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of month starts passed between two dates (not elapsed whole months)."""
    return month_index(end) - month_index(start)


def age_year_diff(birth: ColumnOrName, as_of: dt.date | str | Column) -> Column:
    """Difference of calendar years: one too many before the birthday."""
    return F.year(as_date(as_of)) - F.year(as_column(birth))


def age_exact(birth: ColumnOrName, as_of: dt.date | str | Column) -> Column:
    """Completed years of life: the year difference, less one before the birthday."""
    today, birth = as_date(as_of), as_column(birth)
    before_birthday = _day_of_year_key(today) < _day_of_year_key(birth)
    return age_year_diff(birth, today) - before_birthday.cast("int")


def days_since(day: ColumnOrName, as_of: dt.date | str | Column) -> Column:
    """Days from ``day`` to ``as_of``."""
    return F.datediff(as_date(as_of), as_column(day))


def _day_of_year_key(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)
