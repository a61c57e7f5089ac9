import datetime as dt

from pyspark.sql import functions as F

from rxlens.operators import trend
from rxlens.plans import gold

from .conftest import rows


def month(n):
    return dt.date(2023 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def claims_with_gap(table):
    """14 months from January 2023; month 5 is missing and month 2 has no spend."""
    days = [
        (month(n).replace(day=15), 0.0 if n == 2 else 100.0 * n) for n in range(1, 15) if n != 5
    ]
    return table("claim_date date, total_charge double", *days)


def test_row_and_calendar_growth_differ_at_a_gap(table):
    claims = claims_with_gap(table)
    by_row = {r["claim_month"]: r for r in gold.spend_trend(claims).collect()}
    by_cal = {r["claim_month"]: r for r in gold.spend_trend(claims, calendar=True).collect()}
    assert by_row[month(6)]["prior_month_spend"] == 400.0
    assert by_cal[month(6)]["prior_month_spend"] is None
    # Twelve rows before month 14 there is month 1, as month 5 is missing.
    assert by_row[month(14)]["prior_year_spend"] == 100.0
    assert by_cal[month(14)]["prior_year_spend"] == 0.0
    assert by_cal[month(14)]["yoy_growth_pct"] is None


def test_growth_after_a_month_without_spend_is_null(table):
    got = {r["claim_month"]: r for r in gold.spend_trend(claims_with_gap(table)).collect()}
    assert got[month(2)]["mom_growth_pct"] == -100.0
    assert got[month(3)]["mom_growth_pct"] is None
    assert got[month(4)]["mom_growth_pct"] == 33.33


def test_trend_is_in_month_order_with_short_averages(table):
    got = gold.spend_trend(claims_with_gap(table)).collect()
    assert [r["claim_month"] for r in got] == [month(n) for n in range(1, 15) if n != 5]
    assert [r["moving_avg_3mo"] for r in got[:4]] == [100.0, 50.0, 133.33, 233.33]


def test_trend_by_key_does_not_cross_keys(table):
    df = table(
        "claim_date date, total_charge double, lob string",
        (month(1), 10.0, "a"),
        (month(2), 20.0, "a"),
        (month(2), 5.0, "b"),
        (month(2), 1.0, None),
    )
    got = rows(gold.spend_trend(df, ["lob"]).select("lob", "claim_month", "prior_month_spend"))
    assert got == sorted(
        [("a", month(1), None), ("a", month(2), 10.0), ("b", month(2), None), (None, month(2), None)],
        key=repr,
    )


def periods(table):
    return table(
        "m date, k string, x double",
        *[(month(n), k, float(n * f)) for n in range(1, 5) for k, f in (("a", 1), ("b", 10))],
    )


def test_lag_lead_running_total(table):
    df = trend.with_lag(periods(table), "m", "x", 1, ["k"])
    df = trend.with_lead(df, "m", "x", 2, ["k"])
    df = trend.running_total(df, "m", "x", ["k"])
    got = rows(df.where("k = 'b'"), "m")
    assert [r[3:] for r in got] == [
        (None, 30.0, 10.0),
        (10.0, 40.0, 30.0),
        (20.0, None, 60.0),
        (30.0, None, 100.0),
    ]


def test_growth_pct_and_moving_avg(table):
    df = trend.growth_pct(periods(table), "m", "x", 1, ["k"])
    df = trend.moving_avg(df, "m", "x", 2, ["k"])
    got = rows(df.where("k = 'a'"), "m")
    assert [r[3:] for r in got] == [(None, 1.0), (100.0, 1.5), (50.0, 2.5), (33.33, 3.5)]


def test_shares_sum_to_a_hundred_and_shift(table):
    df = table(
        "m date, s string, n bigint",
        (month(1), "a", 1), (month(1), "b", 2), (month(2), "a", 1), (month(2), "b", 1),
    )
    shifted = trend.share_shift(df, "m", "s", "n")
    assert rows(shifted, "m", "s") == [
        (month(1), "a", 1, 33.33, None),
        (month(1), "b", 2, 66.67, None),
        (month(2), "a", 1, 50.0, 16.67),
        (month(2), "b", 1, 50.0, -16.67),
    ]
    zero = table("m date, s string, n bigint", (month(1), "a", 0))
    assert rows(trend.share_pct(zero, "n", ["m"]).select("share_pct")) == [(None,)]


def test_anomaly_needs_history_and_variation(table):
    values = [10.0, 10.0, 10.0, 11.0, 9.0, 10.0, 90.0, 10.0]
    df = table("m date, x double", *[(month(i + 1), x) for i, x in enumerate(values)])
    got = rows(trend.flag_anomalies(df, "m", "x", window=6).select("m", "z_score", "is_anomaly"), "m")
    assert [r[2] for r in got] == [False] * 6 + [True, False]
    assert [r[1] for r in got[:3]] == [None, None, None]


def test_member_months_count_from_the_effective_month(table):
    members = table(
        "member_id int, plan_id string, effective_date date",
        (1, "A", dt.date(2020, 5, 20)),
        (2, "A", dt.date(2023, 2, 28)),
        (2, "A", dt.date(2023, 3, 1)),
        (3, "B", dt.date(2023, 3, 31)),
        (4, "B", dt.date(2023, 4, 1)),
        (5, "B", None),
    )
    got = rows(gold.member_months(members, "2023-01-01", "2023-03-15"))
    assert got == sorted(
        [
            (month(1), "A", 1), (month(2), "A", 2), (month(3), "A", 2), (month(3), "B", 1),
        ],
        key=repr,
    )


def test_month_totals_need_no_particular_order(table):
    df = claims_with_gap(table).orderBy(F.desc("claim_date"))
    assert gold.month_totals(df).count() == 13
