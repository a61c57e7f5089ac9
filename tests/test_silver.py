import datetime as dt

from rxlens.operators.rows import dedup_best
from rxlens.plans.silver import (
    silver_claims,
    silver_members,
    silver_procedures,
    silver_providers,
)

from .conftest import rows

MEMBER = "member_id int, first_name string, last_name string, birth_date string, gender string, plan_id string, effective_date string"
CLAIM = "claim_id string, member_id string, provider_id string, claim_date string, total_charge double, claim_status string"


def test_member_versions_survive_and_copies_do_not(table):
    raw = table(
        MEMBER,
        (7, " Ann ", "Lee", "1980-02-03", "F", "Exchange", "2020-01-01"),
        (7, "Ann", "Lee ", "1980-02-03", "F", "Exchange", "2020-01-01"),
        (7, "Ann", "Lee", "1980-02-03", "F", "Medicare", "2022-01-01"),
        (None, "No", "Id", None, None, None, None),
        (8, "Bo", "Ray", "not a date", "M", "Exchange", "2020-01-01"),
    )
    got = rows(silver_members(raw))
    assert [r[0] for r in got] == ["7", "7", "8"]
    assert {r[5] for r in got if r[0] == "7"} == {"Exchange", "Medicare"}
    assert got[0][3] == dt.date(1980, 2, 3)
    assert got[2][3] is None


def test_claims_filter_runs_before_rounding(table):
    raw = table(
        CLAIM,
        ("a", "1", "p", "2024-01-02", 0.0, "Approved"),
        ("b", "1", "p", "2024-01-02", -5.0, "Approved"),
        ("c", "1", "p", "2024-01-02", 0.004, "APPROVED"),
        ("d", "1", "p", "2024-01-02", None, "Denied"),
        ("e", "1", "zz", "2024-01-02", 10.005, "On Hold"),
        ("e", "1", "zz", "2024-01-02", 10.005, "ON HOLD"),
        (None, "1", "p", "2024-01-02", 9.0, "Denied"),
    )
    got = rows(silver_claims(raw))
    assert [(r[0], r[4], r[5]) for r in got] == [("c", 0.0, "approved"), ("e", 10.01, "on hold")]


def test_member_ids_join_as_text(table):
    members = silver_members(
        table(MEMBER, (7, "Ann", "Lee", "1980-02-03", "F", "Exchange", "2020-01-01"))
    )
    claims = silver_claims(
        table(
            CLAIM,
            *[
                (f"c{i}", member, "p", "2024-01-02", 1.0, "approved")
                for i, member in enumerate(("007", "7", "x7"))
            ],
        )
    )
    assert [r["claim_id"] for r in claims.join(members, "member_id").collect()] == ["c1"]


def test_providers_need_an_id(table):
    schema = "provider_id string, npi string, provider_name string, specialty string, address string, city string, state string"
    one = ("p1", "1", "Store", "Retail", "1 Way", "Town", "TN")
    raw = table(schema, one, one, (None, "2", "Ghost", "Retail", "", "", "TN"))
    assert rows(silver_providers(raw)) == [one]


def test_procedures_keep_the_dearest_line(table):
    raw = table(
        "claim_id string, procedure_code string, procedure_desc string, amount string",
        ("c1", " ab1 ", " second ", "$1,200.00"),
        ("c1", "AB1", "first", "1200"),
        ("c1", "AB1", "cheap", "99.99"),
        ("c1", "zz9", "other", "99.99"),
        ("c2", "AB1", "no amount", "N/A"),
        ("c2", "AB1", "empty", ""),
        ("c3", "AB1", "zero", "0"),
        (None, "AB1", "no claim", "5"),
    )
    assert rows(silver_procedures(raw)) == [
        ("c1", "AB1", "first", 1200.0, "Very High"),
        ("c1", "ZZ9", "other", 99.99, "Low"),
    ]


def test_procedures_signed(table):
    raw = table(
        "claim_id string, procedure_code string, procedure_desc string, amount string",
        ("c1", "a", "refund", "-12.50"),
    )
    assert rows(silver_procedures(raw)) == [("c1", "A", "refund", 12.5, "Low")]
    assert rows(silver_procedures(raw, keep_sign=True)) == []


def test_empty_feeds(table):
    assert rows(silver_members(table(MEMBER))) == []
    assert rows(silver_claims(table(CLAIM))) == []


def test_dedup_best_is_unique_on_keys(spark):
    df = spark.range(10_000).selectExpr("id % 13 AS k", "id AS v", "id % 7 AS w")
    got = rows(dedup_best(df, ["k"], [df.w.desc(), df.v.asc()]))
    want = {}
    for i in range(10_000):
        best = want.get(i % 13)
        if best is None or (-(i % 7), i) < (-best[2], best[1]):
            want[i % 13] = (i % 13, i, i % 7)
    assert got == sorted(want.values(), key=repr)
