import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rxlens.checks.incremental_queries import CORRECTED, LATE, delivered
from rxlens.plans import gold, incremental
from rxlens.plans.incremental import silver_tables, update_gold, update_silver
from rxlens.plans.pipeline import Layers, build_silver, load_bronze
from rxlens.sources import feeds, layers
from rxlens.sources.star import StarTables
from rxlens.streaming import ingest_incremental, read_ingested, read_rejects
from rxlens.streaming.ingest import LOAD_ID

from .conftest import rows

CLAIMS = feeds.FEEDS["claims"]
HEADER = ",".join(f.name for f in CLAIMS) + "\n"
FIRST = {
    "members": "member_id,first_name,last_name,birth_date,gender,plan_id,effective_date\n"
    "m1,Ann,Lee,1980-01-01,F,A,2020-01-01\nm2,Bo,Ray,,M,B,\n",
    "claims": HEADER
    + "c1,m1,p1,2024-01-05,10.00,Approved\nc2,m1,p2,2024-01-09,20.00,Denied\n"
    + "c3,m2,p1,2024-02-01,30.00,Approved\nc4,m2,p1,,40.00,Approved\n",
    "providers": "provider_id,npi,provider_name,specialty,address,city,state\n"
    "p1,1,One,Retail,,,TN\np2,2,Two,Mail Order,,,GA\n",
    "procedures": "claim_id,procedure_code,procedure_desc,amount\n"
    "c1,a,drug,$5.00\nc1,a,other,$7.00\nc2,b,drug,$0.00\n",
}


class Desk:
    """Folders of one run, and what drops files into them."""

    def __init__(self, spark, base: Path, name: str) -> None:
        self.spark, self.landing = spark, base / "landing"
        self.bronze, self.loads, self.log = (str(base / x) for x in ("bronze", "loads", "log"))
        self.layers = Layers(f"rxlens_test_{name}_", str(base / "tables"))

    def drop(self, feed: str, name: str, text: str) -> None:
        (self.landing / feed).mkdir(parents=True, exist_ok=True)
        (self.landing / feed / name).write_text(text)

    def run(self, update: bool = True):
        load_bronze(self.spark, str(self.landing), self.bronze, self.loads)
        return update_silver(self.spark, self.bronze, self.layers, self.log, 4) if update else None

    def files(self, table: str) -> dict:
        df = self.spark.table(self.layers.place("silver", table)[0])
        part = incremental.KEPT[table].part
        found = df.select(part, F.col("_metadata.file_path")).distinct().collect()
        out: dict = {}
        for value, path in found:
            out.setdefault(value, set()).add(path)
        return out

    def rebuilt(self):
        return build_silver(self.spark, self.bronze, Layers(f"{self.layers.prefix}full_", self.layers.root))


@pytest.fixture
def desk(spark, tmp_path, request):
    made = Desk(spark, tmp_path, request.node.name)
    for feed, text in FIRST.items():
        made.drop(feed, "a.csv", text)
    return made


def same_as_a_full_rebuild(desk):
    full, kept = desk.rebuilt(), silver_tables(desk.spark, desk.layers)
    for feed, df in kept.items():
        assert rows(df.select(*full[feed].columns)) == rows(full[feed]), feed


def test_a_delivery_rewrites_the_months_it_touches(desk):
    first = desk.run()
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    assert set(first["claims"]) == {jan, feb, None} and len(first["members"]) >= 1
    before, members = desk.files("claims"), desk.files("members")
    # A repeated row, a corrected one, a new month; no new row without a date.
    desk.drop(
        "claims",
        "b.csv",
        HEADER + "c3,m2,p1,2024-02-01,30.00,Approved\nc3,m2,p1,2024-02-01,31.00,Approved\n"
        "c5,m1,p2,2024-03-02,50.00,Approved\n",
    )
    assert desk.run() == {"members": [], "claims": [feb, mar], "providers": [], "procedures": []}
    after = desk.files("claims")
    assert after[jan] == before[jan] and after[None] == before[None]
    assert not after[feb] & before[feb] and desk.files("members") == members
    assert all(Path(p.removeprefix("file:")).exists() for p in before[feb])
    same_as_a_full_rebuild(desk)
    assert desk.run() == {feed: [] for feed in FIRST}
    assert desk.files("claims") == after


def test_new_rows_without_a_date(desk):
    desk.run()
    before = desk.files("claims")
    desk.drop("claims", "b.csv", HEADER + "c9,m2,p1,,9.00,Approved\n")
    assert desk.run()["claims"] == [None]
    assert {k: v == before[k] for k, v in desk.files("claims").items()}[None] is False
    same_as_a_full_rebuild(desk)


def test_better_lines_replace_stored_ones(desk):
    desk.run()
    desk.drop(
        "procedures",
        "b.csv",
        "claim_id,procedure_code,procedure_desc,amount\nc1,A,newer,$9.00\nc1,a,cheap,$1.00\n"
        "c2,b,drug,$3.00\nc7,x,drug,bad\n",
    )
    desk.run()
    same_as_a_full_rebuild(desk)
    got = silver_tables(desk.spark, desk.layers)["procedures"].select("claim_id", "amount")
    assert rows(got) == [("c1", 9.0), ("c2", 3.0)]


def test_a_run_that_was_cut_short_is_run_again(desk, monkeypatch):
    desk.run()
    desk.drop("claims", "b.csv", HEADER + "c6,m1,p1,2024-01-06,6.00,Approved\n")
    desk.run(update=False)

    def crash(*_, **__):
        raise RuntimeError("lost")

    point = layers._point_partitions
    monkeypatch.setattr(layers, "_point_partitions", crash)
    with pytest.raises(RuntimeError):
        desk.run()
    monkeypatch.setattr(layers, "_point_partitions", point)
    assert desk.run()["claims"] == [dt.date(2024, 1, 1)]
    same_as_a_full_rebuild(desk)
    # Merged, but not noted down: merging the same load twice changes nothing.
    log = Path(desk.log) / "claims"
    notes = desk.spark.read.parquet(str(log)).collect()
    assert len(notes) == 2
    again = Desk(desk.spark, Path(desk.log).parent, desk.layers.prefix)
    again.layers, again.log = desk.layers, desk.log + "-lost"
    again.run()
    same_as_a_full_rebuild(desk)


def test_only_new_loads_and_touched_months_are_scanned(desk):
    desk.run()
    desk.drop("claims", "b.csv", HEADER + "c6,m1,p1,2024-01-06,6.00,Approved\n")
    desk.run(update=False)
    fresh = incremental.new_loads(desk.spark, f"{desk.bronze}/claims", "claims", f"{desk.log}/claims")
    assert fresh.count() == 1
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and LOAD_ID in plan.split("PartitionFilters: [")[1]


def test_partials_follow_a_correction(desk):
    touched = desk.run()
    update_gold(desk.spark, desk.layers, touched)
    desk.drop("claims", "b.csv", HEADER + "c1,m1,p2,2024-01-05,11.00,Approved\nc8,m1,,2024-04-01,1.00,x\n")
    reports = update_gold(desk.spark, desk.layers, desk.run())
    silver = silver_tables(desk.spark, desk.layers)
    claims, providers = silver["claims"], silver["providers"]
    assert rows(reports["spend_trend"]) == rows(gold.spend_trend(claims))
    assert rows(reports["spend_by_provider"]) == rows(gold.spend_by_provider(claims, providers))
    assert rows(reports["channel_summary"]) == rows(gold.channel_summary(claims, providers))
    by_channel = gold.spend_trend_by_channel(claims, providers)
    assert rows(reports["spend_trend_by_channel"]) == rows(by_channel)
    partials = desk.spark.table(desk.layers.place("gold", incremental.PARTIALS)[0])
    whole = incremental.merge_partials(partials, [])
    assert rows(whole) == [
        (6, 11200, 1.0, 40.0, dt.date(2024, 1, 5), dt.date(2024, 4, 1))
    ]


def test_the_star_tables_touch_few_months(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    _, touched = delivered(t)
    late = {d for d in touched[1]["claims"] if d >= dt.date.fromisoformat(LATE)}
    assert set(touched[1]["claims"]) == late | {dt.date.fromisoformat(CORRECTED)}
    assert len(touched[0]["claims"]) > 5 * len(touched[1]["claims"])


# --- rejected rows ------------------------------------------------------------------------------

BAD = (
    "c1,m1,p1,2020-01-01,5.5,ok\nc2,m1,p1,02/03/2020,abc,ok\nc3,m1\n"
    'c4,m1,p1,2020-01-01,1,"a,b",extra\nc5,,,,,\nc6,"m,1",p1,2020-01-02,,"x"\n'
)


def test_rows_that_do_not_parse_are_kept_apart(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEADER + BAD)
    target, log, rejects = (str(tmp_path / x) for x in ("t", "l", "r"))

    def load(**more):
        return ingest_incremental(spark, str(landing), target, CLAIMS, log, rejects=rejects, **more)

    assert load() == 3 and load() == 0
    got = read_ingested(spark, target, CLAIMS)
    assert rows(got.select("claim_id", "total_charge")) == [("c1", 5.5), ("c5", None), ("c6", None)]
    bad = read_rejects(spark, rejects)
    assert rows(bad.select("record", "reasons")) == [
        ("c2,m1,p1,02/03/2020,abc,ok", ["claim_date", "total_charge"]),
        ("c3,m1", ["field count"]),
        ('c4,m1,p1,2020-01-01,1,"a,b",extra', ["field count"]),
    ]
    assert {r["source_file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv"}
    assert {r[LOAD_ID] for r in bad.collect()} == {r[LOAD_ID] for r in got.collect()}
    assert got.count() + bad.count() == len(BAD.splitlines())
    # A clean load has no rejects, and a projection changes nothing about them.
    (landing / "b.csv").write_text(HEADER + "c7,m1,p1,2020-01-01,x,ok\nc8,m1,p1,2020-01-01,2,ok\n")
    assert load(transform=lambda df: df.select("claim_id")) == 1
    assert read_rejects(spark, rejects).count() == 4


def test_rejects_of_json_and_other_formats(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"claim_id": "c1", "total_charge": 2}\n{"claim_id": 3, oops\n')
    target, log, rejects = (str(tmp_path / x) for x in ("t", "l", "r"))
    args = (spark, str(landing), target, CLAIMS, log)
    assert ingest_incremental(*args, file_format="json", rejects=rejects) == 1
    assert rows(read_rejects(spark, rejects).select("record")) == [('{"claim_id": 3, oops',)]
    with pytest.raises(ValueError):
        ingest_incremental(*args, file_format="parquet", rejects=rejects)


# --- partitions of stored tables ------------------------------------------------------------------


def test_publishing_a_partitioned_table_never_drops_it(spark, table, tmp_path, monkeypatch):
    name, path = "silver.rxlens_test_parts", str(tmp_path / "t")
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    schema = "x int, m string"
    layers.publish(table(schema, (1, "a"), (2, "b"), (3, None)), name, ["m"], path)
    seen = []
    plain = type(spark).sql

    def watch(self, text, *args, **kw):
        seen.append(text)
        return plain(self, text, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", watch)
    layers.publish(table(schema, (4, "a"), (5, "c")), name, ["m"], path)
    assert rows(spark.table(name)) == [(4, "a"), (5, "c")]
    assert not any(text.startswith("DROP TABLE") for text in seen)
    layers.replace_partitions(table(schema, (6, "c"), (7, None)), name, ["m"], path)
    assert rows(spark.table(name)) == [(4, "a"), (6, "c"), (7, None)]
    with pytest.raises(ValueError):
        layers.replace_partitions(table("y int, m string", (1, "a")), name, ["m"], path)


def test_a_merge_moves_its_rows_once(desk):
    """Ranges of partition and key serve the merge and the write; no side is small enough to skip."""
    desk.run()
    for feed, kept in incremental.KEPT.items():
        old = desk.spark.table(desk.layers.place("silver", feed)[0])
        merged = kept.merge(incremental._together(old, old, kept))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning(") == 1, feed
        assert rows(merged) == rows(old), feed


def test_the_first_state_is_not_staged(desk, monkeypatch):
    def stage(df):
        raise AssertionError("staged")

    monkeypatch.setattr(incremental, "checkpoint_stage", stage)
    first = desk.run()
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]
    assert first["claims"] == months and all(first.values())
    same_as_a_full_rebuild(desk)


def test_feeds_may_come_compressed(spark, table, tmp_path):
    """Loaded tables and silver partitions are zstd files."""
    rich = table(CLAIMS, ("c1", "m1", "p1", dt.date(2024, 1, 5), 10.0, "Approved"))
    feeds.export_csv(rich, str(tmp_path / "in"), compression="gzip")
    assert list((tmp_path / "in").glob("*.csv.gz"))
    target = str(tmp_path / "out")
    assert ingest_incremental(spark, str(tmp_path / "in"), target, CLAIMS, str(tmp_path / "log")) == 1
    assert rows(read_ingested(spark, target, CLAIMS).drop(LOAD_ID)) == rows(rich)
    assert list(Path(target).rglob("*.zstd.parquet"))


def test_appended_partitions_bring_no_rows_of_a_state_before(spark, table, tmp_path):
    schema = "x int, m string"
    for run in (1, 2, 3):
        place = {"partition_by": "m", "path": str(tmp_path / f"run{run}")}
        layers.save_layer(table(schema, (run, "a")), "silver", "appended_test", **place)
        late = table(schema, (run, "b"), (run + 10, "a"))
        layers.save_layer(late, "silver", "appended_test", mode="append", **place)
        want = [(run, "a"), (run, "b"), (run + 10, "a")]
        assert rows(spark.table("silver.appended_test")) == sorted(want, key=repr)
