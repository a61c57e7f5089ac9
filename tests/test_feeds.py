import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlens.operators import reuse
from rxlens.sources import feeds, layers
from rxlens.streaming import ingest_incremental, read_ingested
from rxlens.streaming.ingest import LOAD_ID

from .conftest import rows

V1 = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.DoubleType())])
V2 = T.StructType([*V1.fields, T.StructField("flag", T.StringType())])


@pytest.fixture
def folders(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    return landing, str(tmp_path / "bronze"), str(tmp_path / "log")


def drop(landing: Path, name: str, text: str) -> None:
    (landing / name).write_text(text)


def test_only_new_files_are_loaded(spark, folders):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1.5\n2,\n")
    assert ingest_incremental(spark, str(landing), target, V1, log) == 2
    assert ingest_incremental(spark, str(landing), target, V1, log) == 0
    drop(landing, "b.csv", "id,x\n3,3\n")
    assert ingest_incremental(spark, str(landing), target, V1, log) == 1
    got = read_ingested(spark, target)
    assert rows(got.drop(LOAD_ID)) == [("1", 1.5), ("2", None), ("3", 3.0)]
    assert got.select(LOAD_ID).distinct().count() == 2


def test_a_new_column_is_kept(spark, folders):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    ingest_incremental(spark, str(landing), target, V1, log)
    drop(landing, "b.csv", "id,x,flag\n2,2,new\n")
    assert ingest_incremental(spark, str(landing), target, V2, log) == 1
    for schema in (None, V2):
        got = read_ingested(spark, target, schema).select("id", "x", "flag")
        assert rows(got) == [("1", 1.0, None), ("2", 2.0, "new")]
    assert LOAD_ID in read_ingested(spark, target, V2).columns


def test_a_reordered_header_fails_and_loads_nothing(spark, folders):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    ingest_incremental(spark, str(landing), target, V1, log)
    drop(landing, "b.csv", "x,id\n2,2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        ingest_incremental(spark, str(landing), target, V1, log)
    assert rows(read_ingested(spark, target).select("id")) == [("1",)]


def test_a_batch_that_is_run_again_replaces_itself(spark, folders, tmp_path):
    """Crash after the write and before the commit: the batch runs again from the log."""
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    ingest_incremental(spark, str(landing), target, V1, log)
    for name in ("0", ".0.crc"):
        (Path(log) / "commits" / name).unlink()
    assert ingest_incremental(spark, str(landing), target, V1, log) == 1
    assert rows(read_ingested(spark, target).select("id")) == [("1",)]


def test_many_files_are_one_load(spark, folders):
    landing, target, log = folders
    for i in range(5):
        drop(landing, f"{i}.csv", f"id,x\n{i},1\n")
    assert ingest_incremental(spark, str(landing), target, V1, log) == 5
    got = read_ingested(spark, target)
    assert got.count() == 5 and got.select(LOAD_ID).distinct().count() == 1


def test_a_load_that_fails_half_way_shows_nothing(spark, folders):
    landing, target, log = folders
    for i in range(5):
        drop(landing, f"{i}.csv", f"id,x\n{i},1\n")
    drop(landing, "5.csv", "wrong,header\n5,1\n")
    with pytest.raises(Exception):
        ingest_incremental(spark, str(landing), target, V1, log)
    assert not list(Path(target).glob(f"{LOAD_ID}=*/*.parquet"))


def test_a_file_with_an_old_time_is_loaded(spark, folders):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    assert ingest_incremental(spark, str(landing), target, V1, log) == 1
    drop(landing, "b.csv", "id,x\n2,1\n")
    old = time.time() - 8 * 86_400
    os.utime(Path(landing) / "b.csv", (old, old))
    assert ingest_incremental(spark, str(landing), target, V1, log) == 1
    drop(landing, "c.csv", "id,x\n3,1\n")
    assert ingest_incremental(spark, str(landing), target, V1, log) == 1
    assert rows(read_ingested(spark, target).select("id")) == [("1",), ("2",), ("3",)]


def test_projection_and_lineage_during_the_load(spark, folders):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    ingest_incremental(
        spark,
        str(landing),
        target,
        V1,
        log,
        transform=lambda df: feeds.with_lineage(df.select("id", "_metadata")).drop("_metadata"),
    )
    assert rows(read_ingested(spark, target).drop(LOAD_ID)) == [("1", "a.csv")]


def test_another_checkpoint_loads_everything_again(spark, folders, tmp_path):
    landing, target, log = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    ingest_incremental(spark, str(landing), target, V1, log)
    ingest_incremental(spark, str(landing), target, V1, str(tmp_path / "log2"))
    assert read_ingested(spark, target).count() == 2


def test_full_load_modes(spark, folders):
    landing, target, _ = folders
    drop(landing, "a.csv", "id,x\n1,1\n")
    for mode, want in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        feeds.ingest_full(spark, str(landing), target, V1, mode)
        assert spark.read.parquet(target).count() == want


def test_read_feed_with_and_without_schema(spark, folders):
    landing, _, _ = folders
    drop(landing, "a.csv", "id;x\n007;1.5\n")
    assert rows(feeds.read_feed(spark, str(landing), V1, sep=";")) == [("007", 1.5)]
    assert rows(feeds.read_feed(spark, str(landing), sep=";")) == [(7, 1.5)]


def test_export_round_trip(spark, table, tmp_path):
    df = table("id string, x double", ('a,"b"', 1.25), ("c", None))
    feeds.export_csv(df, str(tmp_path / "out"))
    got = feeds.read_feed(spark, str(tmp_path / "out"), V1)
    # The writer escapes quotes the way the reader expects.
    assert rows(got) == rows(df)


def test_inventory_counts_rows_per_file(spark, folders):
    landing, _, _ = folders
    drop(landing, "a.csv", "id,x\n1,1\n2,2\n")
    drop(landing, "b.csv", "id,x\n3,3\n")
    got = feeds.feed_inventory(feeds.read_feed(spark, str(landing), V1)).collect()
    assert {Path(r["file_path"]).name: r["row_count"] for r in got} == {"a.csv": 2, "b.csv": 1}


# --- layers ------------------------------------------------------------------------------------


def test_save_layer_replaces_and_appends(spark, table):
    df = table("m date, x int", (dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 2))
    for _ in range(2):
        got = layers.save_layer(
            df, "silver", "layer_test", partition_by="m", comment="It's a test"
        )
        assert rows(got.select("m", "x")) == rows(df)
    got = layers.save_layer(df, "silver", "layer_test", mode="append", partition_by="m")
    assert got.count() == 4
    described = spark.sql("DESCRIBE EXTENDED silver.layer_test").collect()
    assert any(r["col_name"] == "Comment" and r["data_type"] == "It's a test" for r in described)
    plan = got.where(F.col("m") == dt.date(2024, 1, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_unknown_layer(table):
    with pytest.raises(ValueError):
        layers.save_layer(table("x int", (1,)), "platinum", "t")


def test_insert_rows(spark, table):
    layers.save_layer(table("x int, y string", (1, "a")), "bronze", "insert_test")
    layers.insert_rows(spark, "bronze.insert_test", [(2, "b"), (3, None)])
    got = rows(spark.table("bronze.insert_test"))
    assert got == sorted([(1, "a"), (2, "b"), (3, None)], key=repr)


def test_compact_clusters_and_keeps_every_row(spark, tmp_path):
    src, out = str(tmp_path / "many"), str(tmp_path / "few")
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id % 10 END AS k", "id % 2 AS v")
    df.repartition(20).write.parquet(src)
    got = layers.compact(spark, src, out, 4, ["k"])
    assert got.columns == ["k", "v"]
    assert rows(got.groupBy("k", "v").count()) == rows(df.groupBy("k", "v").count())
    per_file = (
        got.groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("n"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert len(per_file) == 4
    # Ranges follow each other; the hot key 5 is spread over more than one file.
    assert all(a["hi"] <= b["lo"] for a, b in zip(per_file, per_file[1:]))
    assert sum(r["lo"] <= 5 <= r["hi"] for r in per_file) >= 2
    assert max(r["n"] for r in per_file) < 2000
    with pytest.raises(Exception, match="(?i)already exists"):
        layers.compact(spark, src, out, 4, ["k"])


def test_compact_without_clustering(spark, tmp_path):
    src = str(tmp_path / "many")
    spark.range(100).repartition(10).write.parquet(src)
    assert layers.compact(spark, src, str(tmp_path / "few"), 2).count() == 100


def test_history_batch_is_replaced(spark, table, tmp_path):
    path = str(tmp_path / "history")
    layers.write_history(table("x int", (1,)), path, dt.date(2024, 1, 1))
    for value in (2, 3):
        layers.write_history(table("x int", (value,)), path, dt.date(2024, 1, 2))
    assert rows(spark.read.parquet(path).select("x")) == [(1,), (3,)]


# --- reuse -------------------------------------------------------------------------------------


def test_scratch_is_inside_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert reuse.shared_dir(spark) == named
    a, b = (reuse.scratch_path(spark, "x") for _ in range(2))
    assert a != b and a.startswith(named)


def test_checkpoint_stage_starts_a_new_plan(spark):
    df = spark.range(10).repartition(3).withColumn("y", F.col("id") * 2)
    got = reuse.checkpoint_stage(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "parquet" in plan
    assert rows(got) == rows(df)


def test_cached_is_released(spark):
    with reuse.cached(spark.range(5)) as kept:
        assert kept.count() == 5 and kept.storageLevel.useMemory
    assert not kept.storageLevel.useMemory


@pytest.mark.parametrize("name", ["save_layer", "insert_rows", "stored_view"])
def test_stored_tables_can_be_built_again(spark, sf_dir, name):
    from rxlens.checks import QUERIES

    first = rows(QUERIES[name](spark, sf_dir))
    assert rows(QUERIES[name](spark, sf_dir)) == first


def test_a_failed_overwrite_leaves_the_table(spark, table, tmp_path):
    for name, path in (("owned_test", None), ("placed_test", str(tmp_path / "t"))):
        df = table("x int, m int", (1, 1), (2, 2))
        layers.save_layer(df, "silver", name, path=path)
        bad = df.withColumn("x", F.raise_error(F.lit("stop")).cast("int"))
        with pytest.raises(Exception, match="stop"):
            layers.save_layer(bad, "silver", name, path=path)
        assert rows(spark.table(f"silver.{name}")) == [(1, 1), (2, 2)]


def test_publish_may_read_the_table_it_replaces(spark, table):
    layers.save_layer(table("x int", (1,), (2,)), "silver", "swap_test")
    more = spark.table("silver.swap_test").withColumn("x", F.col("x") + 1)
    assert rows(layers.publish(more, "silver.swap_test")) == [(2,), (3,)]
    assert rows(layers.publish(more.selectExpr("x", "x AS y"), "silver.swap_test")) != []


def test_an_empty_batch_replaces_its_history(spark, table, tmp_path):
    path, day = str(tmp_path / "h"), dt.date(2025, 1, 2)
    layers.write_history(table("k int", (1,)), path, day)
    layers.write_history(table("k int", (2,)), path, dt.date(2025, 1, 3))
    layers.write_history(table("k int", (1,)).limit(0), path, day)
    assert rows(spark.read.parquet(path).select("k")) == [(2,)]
    layers.write_history(table("k int", (5,)), path, dt.datetime(2025, 1, 3, 4, 5))
    assert spark.read.parquet(path).count() == 2
