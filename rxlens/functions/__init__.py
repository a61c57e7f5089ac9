"""Column builders. All of them are native expressions, so they stay in generated code."""

from rxlens.functions.columns import (
    average_money,
    band,
    cents,
    clean_amount,
    dollars,
    growth,
    map_code,
    norm_code,
    rate_pct,
    ratio,
    tier,
    total_money,
)
from rxlens.functions.dates import (
    age_exact,
    age_year_diff,
    as_date,
    days_since,
    first_of_month,
    month_boundaries,
    month_index,
)

__all__ = [
    "age_exact",
    "age_year_diff",
    "as_date",
    "average_money",
    "band",
    "cents",
    "clean_amount",
    "days_since",
    "dollars",
    "first_of_month",
    "growth",
    "map_code",
    "month_boundaries",
    "month_index",
    "norm_code",
    "rate_pct",
    "ratio",
    "tier",
    "total_money",
]
