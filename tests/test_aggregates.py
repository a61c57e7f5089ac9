import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rxlens.functions import total_money
from rxlens.operators import aggregates as agg
from rxlens.operators import joins
from rxlens.operators.rows import align_and_union, append_all, top_k, typed

from .conftest import rows

POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def check_percentiles(spark, values, accuracy):
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    got = agg.percentiles(df, "x", POINTS, accuracy=accuracy).first().asDict()
    for name, p in POINTS.items():
        want = pd.Series(values).quantile(p)
        assert got[name] == pytest.approx(want, abs=1e-9), name


@pytest.mark.parametrize("accuracy", [100, 10_000])
@pytest.mark.parametrize("shape", ["uniform", "heavy", "lognormal", "constant", "two", "one"])
def test_percentiles_are_exact(spark, shape, accuracy):
    rng = random.Random(5)
    values = {
        "uniform": [rng.uniform(-50, 50) for _ in range(20_000)],
        "heavy": [7.0 if rng.random() < 0.4 else rng.randrange(1000) / 4 for _ in range(15_000)],
        "lognormal": [rng.lognormvariate(3, 2) for _ in range(12_000)],
        "constant": [3.5] * 5_000,
        "two": [1.0, 2.0],
        "one": [9.0],
    }[shape]
    check_percentiles(spark, values, accuracy)


def test_percentiles_of_nothing(table):
    got = agg.percentiles(table("x double", (None,)), "x", {"p50": 0.5}).collect()
    assert [tuple(r) for r in got] == [(None,)]


def test_percentiles_skip_null(table):
    df = table("x double", (1.0,), (None,), (3.0,))
    assert agg.percentiles(df, "x", {"p50": 0.5}).first()[0] == 2.0


def test_approximate_percentiles(spark):
    df = spark.range(1, 1001)
    assert agg.percentiles(df, "id", {"p50": 0.5}, exact=False).first()[0] == 500.0


def test_percentiles_match_sql(spark, sf_dir):
    got = agg.percentiles(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_totalprice", POINTS, accuracy=50
    ).first()
    cols = ", ".join(f"quantile_cont(o_totalprice, {p})" for p in POINTS.values())
    want = duckdb.sql(f"SELECT {cols} FROM '{sf_dir}/orders.parquet'").fetchall()[0]
    assert tuple(got) == pytest.approx(want, abs=1e-6)


def test_count_when_counts_unknown_values_in_the_total(table):
    df = table("g string, s string", ("a", "x"), ("a", "y"), ("a", None), ("b", "z"))
    got = agg.count_when(df, ["g"], "s", {"xs": "x", "ys": "y"})
    assert rows(got) == [("a", 1, 1, 3), ("b", 0, 0, 1)]


def test_resummarise_average_is_unweighted(table):
    df = table("g string, n int, a double", ("x", 1, 10.0), ("x", 99, 20.0))
    assert rows(agg.resummarise(df, ["g"], ["n"], ["a"])) == [("x", 100, 15.0)]


def test_to_wide_keeps_only_given_values(table):
    df = table("m int, k string, v int", (1, "a", 5), (1, "b", 6), (1, "c", 7), (2, "a", 1))
    got = agg.to_wide(df, ["m"], "k", ["a", "b"], "v")
    assert got.columns == ["m", "a", "b"]
    assert rows(got) == [(1, 5, 6), (2, 1, None)]


def test_freq_orders_by_count(table):
    df = table("a string", ("x",), ("y",), ("y",), (None,))
    assert [tuple(r) for r in agg.freq(df, "a").collect()] == [("y", 2), (None, 1), ("x", 1)]


def test_summarise_empty(table):
    df = table("g string, x double")
    assert rows(agg.summarise(df, ["g"], {"t": total_money("x")})) == []


def test_top_k_breaks_ties(table):
    df = table("id int, x int", (3, 5), (1, 5), (2, 9), (4, 5))
    got = [r["id"] for r in top_k(df, 3, [F.desc("x")], ["id"]).collect()]
    assert got == [2, 1, 3]


def test_append_matches_by_name(table):
    a = table("x int, y string", (1, "a"))
    b = table("y string, x int", ("b", 2))
    assert rows(append_all(a, b)) == [(1, "a"), (2, "b")]


def test_align_and_union_fills_null(table):
    got = align_and_union(table("x int", (1,)), table("x int, y string", (2, "b")))
    assert rows(got) == [(1, None), (2, "b")]


def test_typed_is_tolerant(table):
    df = table("a string, d string", ("1.5", "2024-01-31"), ("x", "31/01/2024"))
    got = typed(df, {"a": "double", "d": "date"})
    assert got.dtypes == [("a", "double"), ("d", "date")]
    assert [r["a"] for r in got.collect()] == [1.5, None]


# --- joins -----------------------------------------------------------------------------------


def test_lookup_default_and_no_fan_out(table):
    df = table("id int, c string", (1, "R"), (2, "Q"), (3, None))
    dim = table("c string, label string", ("R", "Retail"), ("R", "Zzz"), (None, "Null"))
    got = joins.lookup(df, dim, "c", "label", "Unknown").select("id", "label")
    assert rows(got) == [(1, "Retail"), (2, "Unknown"), (3, "Unknown")]


def test_with_scalars_needs_one_row(table):
    df = table("x int", (1,), (2,))
    got = joins.with_scalars(df, table("lo int, hi int", (0, 9)))
    assert rows(got) == [(1, 0, 9), (2, 0, 9)]
    with pytest.raises(Exception, match="(?i)more than one row"):
        joins.with_scalars(df, table("lo int", (0,), (1,))).collect()


def test_reconcile_null_keys_and_missing_sides(table):
    left = table("k string, x int", ("a", 1), ("a", 2), (None, 5), ("l", 7))
    right = table("k string, x int", ("a", 3), (None, 4), ("r", 8))
    got = joins.reconcile(left, right, ["k"], {"x": F.sum("x")})
    assert rows(got) == sorted(
        [
            ("a", 3, 3, 0, True),
            (None, 5, 4, 1, False),
            ("l", 7, None, 7, False),
            ("r", None, 8, -8, False),
        ],
        key=repr,
    )


def test_members_in_plan(table):
    claims = table("claim_id int, member_id int", (1, 1), (2, 2), (3, None))
    members = table("member_id int, plan_id string", (1, "A"), (1, "A"), (2, "B"))
    assert rows(joins.members_in_plan(claims, members, "A").select("claim_id")) == [(1,)]


def test_broadcast_only_behind_the_size_check(spark):
    small = spark.range(10)
    assert joins.estimated_bytes(small) == 80
    hinted = joins.broadcast_if_small(small)._jdf.queryExecution().logical().toString()
    plain = joins.broadcast_if_small(small, 79)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in plain
