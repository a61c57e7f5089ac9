from rxlens.checks.io_queries import medallion
from rxlens.plans import gold
from rxlens.plans.pipeline import Layers, build_silver, load_bronze
from rxlens.sources import feeds
from rxlens.sources.star import AS_OF, StarTables

from .conftest import rows


def test_stored_reports_equal_direct_ones(spark, sf_dir):
    """Through CSV, bronze and silver, against the same reports over the entities."""
    t = StarTables(spark, sf_dir)
    stored = medallion(t)
    claims, members, providers = t.claims(), t.members(), t.providers()
    lines = gold.member_lines(claims, t.procedures())
    direct = {
        "channel_summary": gold.channel_summary(claims, providers),
        "spend_trend": gold.spend_trend(claims),
        "decision_volume": gold.decision_volume(claims, members),
        "approval_by_lob": gold.approval_by_lob(claims, members),
        "pmpm": gold.pmpm(claims, members, "1995-01-01", "2001-08-01"),
    }
    for name, df in direct.items():
        assert rows(stored[name]) == rows(df), name
    high = gold.high_cost_members(claims, lines, members, AS_OF)
    want = {(str(r["member_id"]), r["spend_tier"], r["distinct_drugs"]) for r in high.collect()}
    got = stored["high_cost_members"].collect()
    assert {(r["member_id"], r["spend_tier"], r["distinct_drugs"]) for r in got} == want
    assert spark.catalog.tableExists("gold.rxlens_check_drug_type_mix")


def test_a_second_delivery_adds_to_silver(spark, table, tmp_path):
    landing, bronze, log = (str(tmp_path / x) for x in ("landing", "bronze", "log"))
    one_row = {
        "members": ("m1", "Ann", "Lee", None, "F", "A", None),
        "claims": ("c1", "m1", "p1", None, 5.0, "Approved"),
        "providers": ("p1", "1", "One", "Retail", "", "", "TN"),
        "procedures": ("c1", "a", "drug", "$5.00"),
    }
    for feed, row in one_row.items():
        feeds.export_csv(table(feeds.FEEDS[feed], row), f"{landing}/{feed}")
    layers = Layers("pipeline_test_", str(tmp_path / "tables"))
    assert load_bronze(spark, landing, bronze, log) == dict.fromkeys(feeds.FEEDS, 1)
    assert build_silver(spark, bronze, layers)["claims"].count() == 1
    second = table(feeds.FEEDS["claims"], one_row["claims"], ("c2", "m1", "p1", None, 7.0, "Denied"))
    feeds.export_csv(second, f"{landing}/claims", mode="append")
    assert load_bronze(spark, landing, bronze, log)["claims"] == 2
    again = build_silver(spark, bronze, layers)
    assert rows(again["claims"].select("claim_id", "claim_status")) == [
        ("c1", "approved"),
        ("c2", "denied"),
    ]
    assert again["procedures"].first()["cost_category"] == "Low"


def test_a_feed_without_a_schema_keeps_the_first_one(spark, table, tmp_path):
    landing, bronze, log = (str(tmp_path / x) for x in ("landing", "bronze", "log"))
    for feed, schema in feeds.FEEDS.items():
        spark.createDataFrame([], schema).write.csv(f"{landing}/{feed}", header=True)
    diagnosis = f"{landing}/diagnosis"
    table("claim_id string, code int", ("c1", 7)).write.csv(diagnosis, header=True)
    added = load_bronze(spark, landing, bronze, log, inferred=["diagnosis"])
    assert added["diagnosis"] == 1 and len(added) == 5
    table("claim_id string, code int", ("c2", 8)).write.mode("append").csv(diagnosis, header=True)
    assert load_bronze(spark, landing, bronze, log, inferred=["diagnosis"])["diagnosis"] == 1
    got = spark.read.parquet(f"{bronze}/diagnosis")
    assert dict(got.dtypes)["code"] == "int" and rows(got.select("claim_id")) == [("c1",), ("c2",)]
