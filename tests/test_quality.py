import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlens.operators import quality
from rxlens.sources.feeds import FEEDS

from .conftest import rows

CLAIMS = "claim_id string, provider_id string, claim_date date, total_charge double"
TODAY = dt.date(2024, 6, 30)


def dirty(table):
    return table(
        CLAIMS,
        ("a", "p", TODAY, 1.0),
        (None, "p", TODAY, 1.0),
        ("c", "zz", dt.date(2024, 7, 1), -1.0),
        ("d", None, None, None),
    )


def test_dq_counts_do_not_count_null_as_a_violation(table):
    got = quality.dq_counts(dirty(table), quality.claim_rules(TODAY))
    assert rows(got) == sorted(
        [("null_claim_ids", 1, 4), ("negative_charges", 1, 4), ("future_dates", 1, 4)], key=repr
    )


def test_dq_counts_of_an_empty_table(table):
    got = quality.dq_counts(table(CLAIMS), quality.claim_rules(TODAY))
    assert [r[1:] for r in rows(got)] == [(0, 0)] * 3


def test_enforce_gives_reasons(table):
    good, bad = quality.enforce(dirty(table), quality.claim_rules(TODAY))
    assert [r["claim_id"] for r in good.orderBy("claim_id").collect()] == ["a", "d"]
    reasons = {r["claim_id"]: r[quality.VIOLATIONS] for r in bad.collect()}
    assert reasons == {None: ["null_claim_ids"], "c": ["negative_charges", "future_dates"]}
    assert good.columns == dirty(table).columns


def test_orphans_include_null_keys(table):
    parent = table("provider_id string", ("p",), ("p",))
    got = quality.orphans(dirty(table), parent, "provider_id")
    assert [r[0] for r in rows(got.select("provider_id"))] == ["zz", None]


def test_stage_counts(table):
    df = dirty(table)
    got = quality.stage_counts({"all": df, "dated": df.where("claim_date IS NOT NULL")})
    assert rows(got) == [("all", 4), ("dated", 3)]


def test_counted_during_a_write(table, tmp_path):
    watched, seen = quality.counted(dirty(table), "claims")
    watched.write.parquet(str(tmp_path / "out"))
    assert seen.get["row_count"] == 4


def test_schema_drift():
    old = FEEDS["providers"]
    assert quality.schema_drift(old, old) == []
    kept = [f for f in old if f.name not in ("npi", "city", "state")]
    extra = [T.StructField("state", T.IntegerType()), T.StructField("tax_id", T.LongType())]
    new = T.StructType([kept[1], kept[0], *kept[2:], *extra])
    changes = {(change, name) for change, name, _, _ in quality.schema_drift(old, new)}
    assert ("retyped", "state") in changes
    assert ("lost", "npi") in changes and ("lost", "city") in changes
    assert ("added", "tax_id") in changes
    assert ("moved", "provider_id") in changes and ("moved", "provider_name") in changes


def test_schema_drift_retyped():
    old = T.StructType([T.StructField("x", T.StringType())])
    new = T.StructType([T.StructField("x", T.LongType())])
    assert quality.schema_drift(old, new) == [("retyped", "x", "string", "bigint")]


def test_mark_immature_at_the_edge(table):
    df = table("m date", (dt.date(2024, 3, 1),), (dt.date(2024, 4, 1),), (dt.date(2024, 6, 1),))
    got = quality.mark_immature(df, "m", TODAY, 3)
    assert [r["is_immature"] for r in got.orderBy("m").collect()] == [False, True, True]


def test_null_rules_are_not_violations(table):
    good, bad = quality.enforce(dirty(table), {"odd": F.lit(None).cast("boolean")})
    assert (good.count(), bad.count()) == (4, 0)
