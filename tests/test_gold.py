"""Gold reports on small hand-made tables, against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rxlens.operators.joins import claims_enriched
from rxlens.operators.rows import top_k
from rxlens.plans import gold
from rxlens.sources.star import AS_OF, StarTables

from .conftest import rows

CLAIMS = "claim_id string, member_id string, provider_id string, claim_date date, total_charge double, claim_status string"
MEMBERS = "member_id string, first_name string, last_name string, birth_date date, gender string, plan_id string, effective_date date"
PROVIDERS = "provider_id string, npi string, provider_name string, specialty string, address string, city string, state string"
LINES = "claim_id string, procedure_code string, procedure_desc string, amount double"


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def small(table):
    claims = table(
        CLAIMS,
        ("c1", "m1", "p1", day("2024-01-05"), 100.0, "approved"),
        ("c2", "m1", "p1", day("2024-01-25"), 50.01, "denied"),
        ("c3", "m2", "p2", day("2024-02-05"), 10.0, "Approved"),
        ("c4", "m2", "zz", day("2024-02-06"), 20.0, "on hold"),
        ("c5", "m3", None, day("2024-02-07"), 30.0, "pending"),
        ("c6", "gone", "p1", day("2024-02-08"), 40.0, None),
    )
    members = table(
        MEMBERS,
        ("m1", "Ann", "Lee", day("1990-06-30"), "F", "A", day("2024-01-01")),
        ("m2", "Bo", "Ray", day("1950-06-30"), "M", "B", day("2024-01-01")),
        ("m3", "Cy", "Fox", None, "M", "B", day("2024-02-01")),
    )
    providers = table(
        PROVIDERS,
        ("p1", "1", "One", "Retail", "", "", "TN"),
        ("p2", "2", "Two", "Specialty", "", "", "GA"),
    )
    lines = table(
        LINES,
        ("c1", "A", "a", 99.99),
        ("c1", "B", "b", 100.0),
        ("c2", "A", "a", 1000.0),
        ("c3", "A", "a", 5.0),
        ("c5", "C", "c", 999.99),
        ("none", "A", "a", 1.0),
    )
    return claims, members, providers, lines


def test_unmatched_claims_stay_as_a_null_group(small):
    claims, _, providers, _ = small
    assert rows(gold.channel_summary(claims, providers)) == sorted(
        [
            ("Retail", "TN", 3, 190.01, 63.34),
            ("Specialty", "GA", 1, 10.0, 10.0),
            (None, None, 2, 50.0, 25.0),
        ],
        key=repr,
    )
    spend = gold.spend_by_provider(claims, providers).collect()
    assert [tuple(r) for r in spend] == [
        ("p1", "One", "Retail", 3, 190.01),
        (None, None, None, 2, 50.0),
        ("p2", "Two", "Specialty", 1, 10.0),
    ]


def test_two_versions_of_a_provider_fan_out(small, table):
    claims, _, providers, _ = small
    moved = providers.unionByName(
        table(PROVIDERS, ("p1", "1", "One", "Mail Order", "", "", "TN"))
    )
    got = {r["channel"]: r["claim_count"] for r in gold.channel_summary(claims, moved).collect()}
    assert got == {"Retail": 3, "Mail Order": 3, "Specialty": 1, None: 2}


def test_decisions_drop_unknown_members_and_keep_other_statuses(small):
    claims, members, _, _ = small
    volume = gold.decision_volume(claims, members)
    assert rows(volume, "claim_month", "decision_status") == [
        (day("2024-01-01"), "APPROVED", 1, 100.0, 4.0, 50.0),
        (day("2024-01-01"), "DENIED", 1, 50.01, 24.0, 50.0),
        (day("2024-02-01"), "APPROVED", 1, 10.0, 35.0, 33.33),
        (day("2024-02-01"), "ON HOLD", 1, 20.0, 36.0, 33.33),
        (day("2024-02-01"), "PENDING", 1, 30.0, 6.0, 33.33),
    ]
    assert rows(gold.approval_rate(volume)) == [
        (day("2024-01-01"), 1, 1, 0, 2, 50.0),
        (day("2024-02-01"), 1, 0, 1, 3, 33.33),
    ]
    assert rows(gold.approval_by_lob(claims, members), "claim_month", "lob") == [
        (day("2024-01-01"), "A", 2, 1, 1, 50.0, 14.0),
        (day("2024-02-01"), "B", 3, 1, 0, 33.33, 25.7),
    ]


def test_drug_mix_bands_and_shares(small):
    claims, members, _, lines = small
    got = rows(gold.drug_type_mix(gold.member_lines(claims, lines), members, "2024-12-31"))
    assert got == sorted(
        [
            ("18-34", "F", "A", "Generic (proxy)", 1, 1, 99.99, 99.99, 8.33, "Low credibility"),
            ("18-34", "F", "A", "Brand (proxy)", 1, 1, 100.0, 100.0, 8.33, "Low credibility"),
            ("18-34", "F", "A", "Specialty (proxy)", 1, 1, 1000.0, 1000.0, 83.33, "Low credibility"),
            ("65+", "M", "B", "Generic (proxy)", 1, 1, 5.0, 5.0, 0.5, "Low credibility"),
            ("65+", "M", "B", "Brand (proxy)", 1, 1, 999.99, 999.99, 99.5, "Low credibility"),
        ],
        key=repr,
    )


def test_drug_mix_counts_a_member_once_per_cell(small, table):
    """Two versions of a member in one cell double the lines, not the members."""
    claims, members, _, lines = small
    again = members.unionByName(
        table(MEMBERS, ("m2", "Bo", "Ray", day("1951-01-01"), "M", "B", day("2024-02-01")))
    )
    mix = gold.drug_type_mix(gold.member_lines(claims, lines), again, "2024-12-31")
    mix = mix.where("drug_type LIKE 'Gen%'")
    got = {r["lob"]: (r["line_count"], r["member_count"]) for r in mix.collect()}
    assert got == {"A": (1, 1), "B": (2, 1)}


def test_high_cost_members_without_drugs_count_zero(small):
    claims, members, _, lines = small
    none = gold.member_lines(claims, lines).where("false")
    got = gold.high_cost_members(claims, none, members, "2024-12-31").collect()
    # Spend: m1 150.01, m2 30, m3 30, gone 40; the 75th percentile is 67.5025.
    assert [(r["member_id"], r["distinct_drugs"], r["polypharmacy_flag"]) for r in got] == [
        ("m1", 0, "Standard")
    ]
    assert got[0]["p75_threshold"] == 67.5025
    assert got[0]["spend_tier"] == "Tier 1 — Critical (95th+ pct)"
    assert got[0]["age"] == 34 and got[0]["days_since_last_fill"] == 341


def test_tiers_include_their_threshold(table):
    """With 101 members of spend 0..100 the thresholds are members' own amounts."""
    claims = table(
        CLAIMS, *[(f"c{i}", f"m{i}", "p", day("2024-01-01"), float(i), "approved") for i in range(101)]
    )
    members = table(
        MEMBERS, *[(f"m{i}", "", "", day("2000-01-01"), "F", "A", day("2023-01-01")) for i in range(101)]
    )
    lines = table(LINES, *[("c100", f"d{k}", "", 1.0) for k in range(10)], ("c99", "d", "", 1.0))
    joined = gold.member_lines(claims, lines)
    got = gold.high_cost_members(claims, joined, members, "2024-12-31").collect()
    tiers = defaultdict(list)
    for r in got:
        tiers[r["spend_tier"][:6]].append(r["total_drug_spend"])
    assert {k: (min(v), max(v)) for k, v in tiers.items()} == {
        "Tier 1": (95.0, 100.0), "Tier 2": (90.0, 94.0), "Tier 3": (75.0, 89.0),
    }
    assert got[0]["polypharmacy_flag"].startswith("Polypharmacy")
    assert got[1]["polypharmacy_flag"] == "Standard"


def test_staging_does_not_change_the_result(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    lines = gold.member_lines(t.claims(False), t.procedures(False))
    parts = (t.claims(False), lines, t.members(), AS_OF)
    staged = gold.high_cost_members(*parts)
    lazy = gold.high_cost_members(*parts, stage=lambda df: df)
    assert rows(staged) == rows(lazy)


def test_top_members_are_the_dearest(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    spend = gold.member_summary(t.claims(False))
    got = top_k(spend, 20, [F.desc("total_drug_spend")], ["member_id"]).collect()
    want = sorted(spend.collect(), key=lambda r: (-r["total_drug_spend"], r["member_id"]))[:20]
    assert got == want


def test_pmpm_shows_months_without_claims(small):
    claims, members, _, _ = small
    got = rows(gold.pmpm(claims, members, "2024-01-01", "2024-03-01"), "claim_month", "lob")
    assert got == [
        (day("2024-01-01"), "A", 1, 2, 150.01, 150.01, 2.0),
        (day("2024-01-01"), "B", 1, 0, 0.0, 0.0, 0.0),
        (day("2024-02-01"), "A", 1, 0, 0.0, 0.0, 0.0),
        (day("2024-02-01"), "B", 2, 3, 60.0, 30.0, 1.5),
        (day("2024-03-01"), "A", 1, 0, 0.0, 0.0, 0.0),
        (day("2024-03-01"), "B", 2, 0, 0.0, 0.0, 0.0),
    ]


def test_pmpm_keeps_members_without_a_line_and_counts_versions_once(table):
    members = table(
        MEMBERS,
        ("m1", "Ann", "Lee", day("1990-06-30"), "F", None, day("2024-01-01")),
        ("m2", "Bo", "Ray", day("1950-06-30"), "M", "A", day("2023-01-01")),
        ("m2", "Bo", "Ray", day("1950-06-30"), "M", "B", day("2024-01-01")),
    )
    claims = table(
        CLAIMS,
        ("c1", "m1", "p1", day("2024-01-05"), 10.0, "approved"),
        ("c2", "m2", "p1", day("2024-01-31"), 10.0, "approved"),
        ("c3", "m2", "p1", day("2024-02-01"), 99.0, "approved"),
    )
    got = rows(gold.pmpm(claims, members, "2024-01-01", "2024-01-01"))
    assert got == sorted(
        [
            (day("2024-01-01"), None, 1, 1, 10.0, 10.0, 1.0),
            (day("2024-01-01"), "B", 1, 1, 10.0, 10.0, 1.0),
        ],
        key=repr,
    )


def test_pre_post_splits_the_event_month(table):
    df = table(
        "k string, claim_date date, total_charge double",
        ("x", day("2024-01-10"), 100.0),
        ("x", day("2024-02-10"), 50.0),
        ("x", day("2024-02-15"), 30.0),
        ("x", day("2024-02-20"), 30.0),
        ("y", day("2024-03-01"), 10.0),
        ("y", None, 99.0),
    )
    got = rows(gold.pre_post(df, ["k"], "2024-02-15"))
    assert got == [
        ("x", 2, 1, 2, 2, 150.0, 60.0, 75.0, 60.0, -20.0, 15.0),
        ("y", 0, 1, 0, 1, 0.0, 10.0, None, 10.0, None, None),
    ]


def test_impact_subtracts_the_comparison(small):
    claims, _, providers, _ = small
    got = gold.channel_impact(claims, providers, "Retail", "2024-02-01").first().asDict()
    assert got["treated_change"] == round(40.0 - 150.01, 2)
    assert got["comparison_pre"] is None and got["impact"] is None


def test_channel_totals_add_up_to_all(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    whole = gold.month_totals(t.claims()).agg(F.sum("claim_count"), F.sum("cents")).first()
    summary = gold.channel_summary(t.claims(), t.providers())
    cents = F.floor(F.col("total_drug_spend") * 100 + 0.5)
    assert tuple(summary.agg(F.sum("claim_count"), F.sum(cents)).first()) == tuple(whole)
    enriched = claims_enriched(t.claims(), t.members(), t.providers())
    assert enriched.count() == whole[0]


def test_trend_by_channel_equals_trend_of_the_join(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    places = t.providers().select("provider_id", F.col("specialty").alias("channel"))
    joined = t.claims().join(places, "provider_id", "left")
    assert rows(gold.spend_trend_by_channel(t.claims(), t.providers())) == rows(
        gold.spend_trend(joined, ["channel"])
    )
    assert rows(gold.pre_post_by_channel(t.claims(), t.providers(), "1998-04-15")) == rows(
        gold.pre_post(joined, ["channel"], "1998-04-15")
    )


def test_hot_keys_change_nothing(spark):
    """A third of all rows on one member, pharmacy and claim: totals still add up."""
    rng = random.Random(3)
    data = [
        (
            f"c{i}" if i % 3 else "hot",
            "m0" if i % 3 == 0 else f"m{rng.randrange(50)}",
            "p0" if i % 3 == 0 else f"p{rng.randrange(9)}",
            dt.date(2024, 1 + rng.randrange(6), 3),
            rng.randrange(1, 10_000) / 100,
            "approved",
        )
        for i in range(6000)
    ]
    claims = spark.createDataFrame(data, CLAIMS).repartition(6)
    spend, count = defaultdict(int), defaultdict(int)
    for row in data:
        spend[row[1]] += round(row[4] * 100)
        count[row[1]] += 1
    got = {r["member_id"]: r for r in gold.member_summary(claims).collect()}
    assert {k: (r["claim_count"], r["total_drug_spend"]) for k, r in got.items()} == {
        k: (count[k], spend[k] / 100) for k in spend
    }


def test_shares_fill_their_group(spark, sf_dir):
    """Rounded shares of a month or cell add up to a hundred, give or take the rounding."""
    t = StarTables(spark, sf_dir)
    volume = gold.decision_volume(t.claims(False), t.members())
    mix = gold.drug_type_mix(gold.member_lines(t.claims(False), t.procedures(False)), t.members(), AS_OF)
    for df, by, share in (
        (volume, ["claim_month"], "pct_of_month"),
        (mix, ["age_band", "gender", "lob"], "pct_of_cell_spend"),
    ):
        for row in df.groupBy(*by).agg(F.sum(share).alias("s")).collect():
            assert abs(row["s"] - 100) <= 0.02


def test_known_statuses_never_exceed_the_total(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    rates = gold.approval_rate(gold.decision_volume(t.claims(False), t.members()))
    known = F.col("approved") + F.col("denied") + F.col("pending")
    assert rates.where(known > F.col("total_claims")).count() == 0
    assert rates.agg(F.sum("total_claims")).first()[0] == t.claims(False).count()


def test_a_stored_drug_trend_is_not_sorted(table):
    lines = table(
        "claim_date date, procedure_code string, amount double",
        *[(dt.date(2024, m, 1), code, 5.0 * m) for m in (3, 1, 2) for code in ("b", "a")],
    )
    stored, shown = gold.spend_trend_by_drug(lines, ordered=False), gold.spend_trend_by_drug(lines)
    assert rows(stored) == rows(shown)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (stored, shown)]
    assert ["rangepartitioning" in plan for plan in plans] == [False, True]
