import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxlens.operators import tables

from .conftest import rows

KV = "k int, v string"
STATE = st.dictionaries(
    st.integers(0, 12), st.one_of(st.none(), st.sampled_from("abc")), max_size=8
)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, state):
    return spark.createDataFrame(list(state.items()), KV)


def test_upsert_updates_inserts_and_keeps(table):
    target = table(KV, (1, "a"), (2, "b"), (None, "n"))
    source = table(KV, (2, "B"), (3, "C"), (None, "m"), (None, "m"))
    got = tables.upsert(target, source, ["k"])
    assert rows(got) == sorted(
        [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "m"), (None, "m")], key=repr
    )


def test_upsert_rejects_duplicate_source_keys(table):
    target = table(KV, (1, "a"), (2, "b"))
    with pytest.raises(Exception, match="duplicate source key"):
        tables.upsert(target, table(KV, (2, "x"), (2, "y")), ["k"]).collect()


def test_upsert_rejects_duplicates_for_an_empty_target(spark, table):
    empty = table(KV, (1, "a")).limit(0)
    literal = spark.createDataFrame([], KV)
    for target in (empty, literal):
        with pytest.raises(Exception, match="duplicate source key"):
            tables.upsert(target, table(KV, (1, "x"), (1, "y")), ["k"]).collect()
        got = tables.upsert(target, table(KV, (None, "x"), (None, "x"), (2, "y")), ["k"])
        assert got.count() == 3


def test_upsert_takes_columns_by_name(table):
    got = tables.upsert(table(KV, (1, "a")), table("v string, k int", ("z", 1)), ["k"])
    assert rows(got) == [(1, "z")]


@FEW
@given(target=STATE, source=STATE)
def test_upsert_twice_is_upsert_once(spark, target, source):
    batch = frame(spark, source)
    once = tables.upsert(frame(spark, target), batch, ["k"])
    assert rows(once) == sorted((target | source).items(), key=repr)
    assert rows(tables.upsert(once, batch, ["k"])) == rows(once)


@FEW
@given(old=STATE, new=STATE)
def test_changes_lead_from_old_to_new(spark, old, new):
    before, after = frame(spark, old), frame(spark, new)
    feed = tables.change_feed(before, after, ["k"])
    assert rows(tables.apply_changes(before, feed, ["k"])) == sorted(new.items(), key=repr)
    kinds = {row["_change"] for row in feed.collect()}
    if old == new:
        assert not kinds


def test_change_feed_labels(table):
    old = table(KV, (1, "a"), (2, "b"), (3, None), (4, "d"), (None, "x"))
    new = table(KV, (1, "a"), (2, "B"), (3, "c"), (5, "e"), (None, "y"))
    assert rows(tables.change_feed(old, new, ["k"])) == sorted(
        [
            (2, "b", "update_pre"),
            (2, "B", "update_post"),
            (3, None, "update_pre"),
            (3, "c", "update_post"),
            (4, "d", "delete"),
            (5, "e", "insert"),
            (None, "x", "update_pre"),
            (None, "y", "update_post"),
        ],
        key=repr,
    )


def test_update_and_delete_leave_null_conditions_alone(table):
    df = table(KV, (1, "a"), (None, "b"), (3, "c"))
    got = tables.update_where(df, F.col("k") > 2, {"v": F.lit("new")})
    assert rows(got) == sorted([(1, "a"), (None, "b"), (3, "new")], key=repr)
    assert rows(tables.delete_where(df, F.col("k") > 2)) == sorted([(1, "a"), (None, "b")], key=repr)


def test_update_reads_old_values(table):
    df = table("a int, b int", (1, 2))
    got = tables.update_where(df, F.lit(True), {"a": F.col("b"), "b": F.col("a")})
    assert rows(got) == [(2, 1)]


DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def history_of(table, states):
    history = None
    previous = table(KV)
    for day, state in zip(DAYS, states):
        feed = tables.change_feed(previous, state, ["k"])
        if history is None:
            history = feed.withColumn("batch_ts", F.lit(day))
        else:
            history = tables.apply_history(history, feed, day)
        previous = state
    return history


def test_as_of_gives_every_past_state(table):
    states = [
        table(KV, (1, "a"), (2, "b")),
        table(KV, (1, "A"), (3, "c")),
        table(KV, (2, "again"), (3, "c")),
    ]
    history = history_of(table, states)
    for day, state in zip(DAYS, states):
        got = tables.as_of(history, ["k"], "batch_ts", day).select("k", "v")
        assert rows(got) == rows(state)
    assert rows(tables.as_of(history, ["k"], "batch_ts", dt.date(2023, 1, 1))) == []


def test_a_batch_applied_again_replaces_itself(table):
    history = history_of(table, [table(KV, (1, "a"))])
    feed = tables.change_feed(table(KV, (1, "a")), table(KV, (1, "b")), ["k"])
    once = tables.apply_history(history, feed, DAYS[1])
    assert rows(tables.apply_history(once, feed, DAYS[1])) == rows(once)


def test_as_of_without_change_labels(table):
    history = table("k int, v string, ts date", (1, "a", DAYS[0]), (1, "b", DAYS[2]))
    assert rows(tables.as_of(history, ["k"], "ts", DAYS[1])) == [(1, "a", DAYS[0])]
