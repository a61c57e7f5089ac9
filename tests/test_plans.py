"""Shape of the physical plans, with broadcasts off as for large tables."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from rxlens.checks import QUERIES
from rxlens.operators.joins import with_lob
from rxlens.plans import gold
from rxlens.plans.silver import silver_procedures
from rxlens.sources.star import AS_OF, StarTables


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def star(spark, sf_dir):
    return StarTables(spark, sf_dir)


LAZY = sorted(name for name, run in QUERIES.items() if "io_queries" not in run.__module__)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    with settings(spark, NO_BROADCAST):
        plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, f"{word} in the plan of {name}"


@pytest.mark.parametrize(
    "name", ["spend_trend", "spend_trend_by_drug", "running_total", "flag_anomalies", "share_shift"]
)
def test_windows_come_after_an_aggregate(spark, sf_dir, name):
    """Below every window there is an aggregate, so no window sees raw claims."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Window [" in plan
    assert plan.rindex("Window [") < plan.rindex("HashAggregate")


def test_best_row_is_picked_before_the_shuffle(star):
    raw = star.procedures().withColumn("procedure_code", F.col("procedure_code").cast("string"))
    plan = plan_of(silver_procedures(raw))
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(claim_id")
    assert plan.index("row_number(), 1, Final") < exchange < partial
    assert len(re.findall("regexp_replace", plan)) == 1


def test_claims_are_reduced_before_the_provider_join(spark, star):
    with settings(spark, NO_BROADCAST):
        plan = plan_of(gold.channel_summary(star.claims(), star.providers()))
    join = plan.index("SortMergeJoin [provider_id")
    assert "partial_count" in plan[join:].split("FileScan")[0]


def test_unused_provider_costs_nothing(star):
    """The line items that give a claim its pharmacy are not read when it is not used."""
    plan = plan_of(gold.spend_trend(star.claims(with_provider=False)))
    assert "lineitem" not in plan


def test_scan_reads_only_what_it_needs(star):
    plan = plan_of(star.claims(with_provider=False).where("claim_date < '1996-01-01'").select("claim_id"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "LessThan(o_orderdate" in plan


def test_member_months_never_explode_members(star):
    plan = plan_of(gold.member_months(star.members(), "1995-01-01", "2001-08-01"))
    generate = plan.index("Generate explode")
    assert plan[generate:].count("HashAggregate") >= 4


def test_percentiles_do_not_sort_all_values_in_one_task(star):
    plan = plan_of(gold.member_percentiles(gold.member_summary(star.claims(False))))
    single = plan.index("Exchange SinglePartition")
    below = plan[single:].split("\n")[1]
    assert "HashAggregate" in below


def test_a_hot_member_is_split_by_the_join(spark):
    """A third of all claims on one member: the join splits that partition."""
    low = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    claims = spark.range(0, 120_000, 1, 12).selectExpr(
        "id AS claim_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 4000 END AS member_id",
        "date_add(DATE '2024-01-01', CAST(id % 300 AS INT)) AS claim_date",
        "CAST(id % 1000 AS DOUBLE) / 8 AS total_charge",
        "'approved' AS claim_status",
    )
    members = spark.range(4000).selectExpr(
        "id AS member_id", "CAST(id % 5 AS STRING) AS plan_id", "DATE '2023-01-01' AS effective_date"
    )
    with settings(spark, low):
        report = gold.spend_trend(with_lob(claims, members), ["lob"])
        count = sum(row["claim_count"] for row in report.collect())
        assert "SortMergeJoin(skew=true)" in plan_of(report)
    assert count == 120_000


def test_drug_mix_reduces_lines_before_members_join(spark, star):
    with settings(spark, NO_BROADCAST):
        lines = gold.member_lines(star.claims(False), star.procedures(with_desc=False))
        plan = plan_of(gold.drug_type_mix(lines, star.members(), AS_OF))
    member_join = plan.index("SortMergeJoin [member_id")
    line_join = plan.index("SortMergeJoin [claim_id")
    assert "partial_sum" in plan[member_join:line_join]
    # Only the columns this report needs are read.
    assert "l_partkey" not in plan and "o_orderdate" not in plan


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    plan = plan_of(QUERIES["top_members"](spark, sf_dir))
    assert "TakeOrderedAndProject(limit=20" in plan
    assert "rangepartitioning" not in plan


def test_a_wrong_column_name_fails_before_any_job(star):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        star.claims().filter(F.col("bad_column") == 1)


def test_upsert_moves_only_source_keys_when_they_are_few(spark, star):
    from rxlens.operators.tables import upsert

    target = star.claims(with_provider=False)
    batch = target.where("claim_date >= '2001-07-01'")
    plan = plan_of(upsert(target, batch, ["claim_id"]))
    anti = plan.index("BroadcastHashJoin [claim_id")
    assert "LeftAnti" in plan[anti:].split("\n")[0]
