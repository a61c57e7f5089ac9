"""Labels, money and ratios as Column expressions.

Money is added up as whole cents in a BIGINT. That makes a sum independent of the order
in which tasks deliver their rows, and it keeps the aggregation buffer a primitive, so
the partial aggregate stays in generated code. A sum may reach 9.2e16 dollars; beyond
that ANSI mode raises instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxlens.values import AMOUNT_NOISE, SIGNED_AMOUNT_NOISE

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def band(
    value: ColumnOrName,
    cuts: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
) -> Column:
    """Label of the half-open band that holds ``value``.

    ``labels`` has one entry more than ``cuts``. A NULL satisfies no comparison, so it
    gets the last label unless ``null_label`` names another.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("band needs one label more than cut points")
    if list(cuts) != sorted(cuts):
        raise ValueError("cut points must ascend")
    value = as_column(value)
    top = F.lit(labels[-1])
    if null_label is not None:
        top = F.when(value.isNull(), F.lit(null_label)).otherwise(top)
    picked = F
    for cut, label in zip(cuts, labels):
        picked = picked.when(value < cut, F.lit(label))
    return picked.otherwise(top) if cuts else top


def tier(
    value: ColumnOrName,
    steps: Sequence[tuple[ColumnOrName | float, str]],
    default: str,
) -> Column:
    """Label of the first step whose threshold ``value`` reaches; highest step first.

    A threshold is a number, or a column that holds one.
    """
    value = as_column(value)
    picked = F
    for threshold, label in steps:
        bound = as_column(threshold) if isinstance(threshold, (str, Column)) else F.lit(threshold)
        picked = picked.when(value >= bound, F.lit(label))
    return picked.otherwise(F.lit(default))


def map_code(code: ColumnOrName, labels: Mapping[str, str], default: str) -> Column:
    """Label of a code from a short fixed list. Longer lists belong in ``lookup``."""
    code = as_column(code)
    picked = F
    for key, label in labels.items():
        picked = picked.when(code == key, F.lit(label))
    return picked.otherwise(F.lit(default))


def norm_code(code: ColumnOrName) -> Column:
    """Text key without outer blanks, in upper case."""
    return F.upper(F.trim(as_column(code)))


def clean_amount(amount: ColumnOrName, keep_sign: bool = False) -> Column:
    """Number in a money text, rounded to cents; NULL when no number is left.

    The default keeps digits and dots only, so a refund of ``-12.50`` comes out as
    ``12.5``. ``keep_sign=True`` reads any text that already is a number as it stands
    (sign and exponent included) and keeps a minus sign otherwise.
    """
    text = as_column(amount).cast("string")
    if keep_sign:
        stripped = F.regexp_replace(text, SIGNED_AMOUNT_NOISE, "").try_cast("double")
        number = F.coalesce(text.try_cast("double"), stripped)
    else:
        number = F.regexp_replace(text, AMOUNT_NOISE, "").try_cast("double")
    return F.round(number, 2)


def cents(amount: ColumnOrName) -> Column:
    """Whole cents (BIGINT) of an amount that has at most two decimals."""
    return F.floor(as_column(amount) * 100 + F.lit(0.5)).cast("bigint")


def dollars(whole_cents: ColumnOrName) -> Column:
    """DOUBLE amount of a number of whole cents."""
    return as_column(whole_cents).cast("double") / F.lit(100.0)


def total_money(amount: ColumnOrName) -> Column:
    """Aggregate: exact sum of a money column, as DOUBLE with two decimals."""
    return dollars(F.sum(cents(amount)))


def average_money(amount: ColumnOrName) -> Column:
    """Aggregate: mean of a money column over its non-null rows, to two decimals."""
    whole = cents(amount)
    return ratio(F.sum(whole), F.count(whole) * 100)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName, scale: int = 2) -> Column:
    """Rounded quotient as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.round(
        F.try_divide(
            as_column(numerator).cast("double"), as_column(denominator).cast("double")
        ),
        scale,
    )


def rate_pct(numerator: ColumnOrName, denominator: ColumnOrName, scale: int = 2) -> Column:
    """``numerator`` as a percentage of ``denominator``; NULL-safe like :func:`ratio`."""
    return ratio(as_column(numerator).cast("double") * 100, denominator, scale)


def growth(current: ColumnOrName, prior: ColumnOrName, scale: int = 2) -> Column:
    """Percent change from ``prior`` to ``current``; NULL when ``prior`` is zero or NULL."""
    current, prior = as_column(current), as_column(prior)
    change = F.try_divide((current - prior).cast("double"), prior.cast("double"))
    return F.round(change * 100, scale)
