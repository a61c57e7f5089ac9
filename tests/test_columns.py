import datetime as dt

import pytest
from pyspark.sql import functions as F

from rxlens import functions as fn
from rxlens import values as v


def column(df, expr):
    return [row[0] for row in df.select(expr).collect()]


def test_band_edges_are_half_open(table):
    df = table("x double", (99.99,), (100.0,), (499.99,), (500.0,), (999.99,), (1000.0,), (None,))
    labels = column(df, fn.band("x", v.COST_CUTS, v.COST_LABELS))
    assert labels == ["Low", "Medium", "Medium", "High", "High", "Very High", "Very High"]


def test_band_null_label(table):
    df = table("x double", (None,), (1.0,))
    assert column(df, fn.band("x", v.RISK_CUTS, v.RISK_LABELS, "No charge")) == ["No charge", "Low"]


@pytest.mark.parametrize("cuts,labels", [((1, 2), ("a", "b")), ((2, 1), ("a", "b", "c"))])
def test_band_rejects_bad_cuts(cuts, labels):
    with pytest.raises(ValueError):
        fn.band("x", cuts, labels)


def test_tier_reaches_threshold(table):
    df = table("n int", (4,), (5,), (9,), (10,), (None,))
    assert column(df, fn.tier("n", v.POLYPHARMACY_TIERS, v.POLYPHARMACY_DEFAULT)) == [
        "Standard",
        "Watch list",
        "Watch list",
        "Polypharmacy — Refer to clinical review",
        "Standard",
    ]


def test_tier_against_columns(table):
    df = table("x double, high double, low double", (3.0, 3.0, 1.0), (2.9, 3.0, 1.0), (0.5, 3.0, 1.0))
    assert column(df, fn.tier("x", [("high", "H"), ("low", "L")], "-")) == ["H", "L", "-"]


def test_map_code_default(table):
    df = table("c string", ("R",), ("M",), ("S",), ("Q",), (None,))
    assert column(df, fn.map_code("c", v.CHANNEL_CODES, v.UNKNOWN_LABEL)) == [
        "Retail",
        "Mail Order",
        "Specialty",
        "Unknown",
        "Unknown",
    ]


AMOUNTS = ("$1,234.50", " 99.99", "-12.50", "1.2.3", "", "N/A", "1.23456789E7", None)


def test_clean_amount_drops_sign_and_exponent(table):
    df = table("a string", *[(a,) for a in AMOUNTS])
    got = column(df, fn.clean_amount("a"))
    assert got == [1234.5, 99.99, 12.5, None, None, None, 1.23, None]


def test_clean_amount_keeps_sign(table):
    df = table("a string", *[(a,) for a in AMOUNTS], ("-$3.10",))
    got = column(df, fn.clean_amount("a", keep_sign=True))
    assert got == [1234.5, 99.99, -12.5, None, None, None, 12345678.9, None, -3.1]


def test_clean_amount_of_a_number(table):
    df = table("a double", (12.5,), (-12.5,))
    assert column(df, fn.clean_amount("a")) == [12.5, 12.5]


def test_norm_code(table):
    df = table("c string", ("  ab-1 ",), (None,))
    assert column(df, fn.norm_code("c")) == ["AB-1", None]


def test_cents_are_exact(table):
    amounts = [(k / 100.0,) for k in range(-2000, 200000, 7)]
    df = table("a double", *amounts)
    assert column(df, fn.cents("a")) == list(range(-2000, 200000, 7))


def test_money_sum_does_not_depend_on_order(spark):
    df = spark.range(100_000).select((F.col("id") % 97 / 100.0).alias("a"))
    want = sum(i % 97 for i in range(100_000)) / 100
    for parts in (1, 7):
        got = df.repartition(parts).agg(fn.total_money("a")).first()[0]
        assert got == want


def test_average_money_rounds_half_up_and_skips_null(table):
    df = table("a double", (10.0,), (0.01,), (None,))
    assert column(df, fn.average_money("a")) == [5.01]


def test_ratio_and_rate_with_zero_or_null_denominator(table):
    df = table("n int, d int", (1, 3), (1, 0), (1, None), (1, 32))
    assert column(df, fn.ratio("n", "d", 3)) == [0.333, None, None, 0.031]
    assert column(df, fn.rate_pct("n", "d")) == [33.33, None, None, 3.13]


def test_growth_with_zero_prior(table):
    df = table("c double, p double", (150.0, 100.0), (1.0, 0.0), (1.0, None))
    assert column(df, fn.growth("c", "p")) == [50.0, None, None]


AS_OF = "2024-06-15"


def test_ages_before_and_after_the_birthday(table):
    days = [dt.date(2000, 12, 31), dt.date(2000, 1, 1), dt.date(2000, 6, 15), dt.date(2000, 6, 16), None]
    df = table("b date", *[(d,) for d in days])
    assert column(df, fn.age_year_diff("b", AS_OF)) == [24, 24, 24, 24, None]
    assert column(df, fn.age_exact("b", AS_OF)) == [23, 24, 24, 23, None]


def test_age_bands_at_the_cuts_and_null(table):
    born = [2024 - a for a in (17, 18, 34, 35, 49, 50, 64, 65)]
    df = table("b date", *[(dt.date(y, 12, 31),) for y in born], (None,))
    age = fn.age_year_diff("b", AS_OF)
    assert column(df, fn.band(age, v.AGE_CUTS, v.AGE_LABELS)) == [
        "0-17", "18-34", "18-34", "35-49", "35-49", "50-64", "50-64", "65+", "65+",
    ]
    assert column(df, fn.band(age, v.AGE_CUTS, v.AGE_LABELS, "unknown"))[-1] == "unknown"


def test_month_helpers(table):
    df = table("a date, b date", (dt.date(2024, 1, 31), dt.date(2024, 2, 1)))
    assert column(df, fn.month_boundaries("a", "b")) == [1]
    assert column(df, fn.first_of_month("a")) == [dt.date(2024, 1, 1)]
    assert column(df, fn.days_since("a", "2024-02-01")) == [1]
    assert column(df, F.add_months("a", 1)) == [dt.date(2024, 2, 29)]


def test_first_of_month_of_timestamp_without_zone_is_a_date(table):
    df = table("t timestamp_ntz", (dt.datetime(2024, 5, 17, 23, 59),))
    assert df.select(fn.first_of_month("t").alias("m")).dtypes == [("m", "date")]
