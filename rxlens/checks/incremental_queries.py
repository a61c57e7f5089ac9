"""Deliveries after the first: rejected rows, silver by touched partitions, reports from partials."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.checks.gold_queries import month_totals, trend_sql
from rxlens.checks.registry import half_up, query
from rxlens.functions import as_date
from rxlens.operators.reuse import scratch_path
from rxlens.plans.incremental import silver_tables, update_gold, update_silver
from rxlens.plans.pipeline import Layers, load_bronze
from rxlens.sources import feeds
from rxlens.sources.star import StarTables
from rxlens.streaming import ingest_incremental, read_ingested, read_rejects

#: Claims from this day on, and corrections of one older month, come with the second delivery.
LATE = "2001-07-01"
CORRECTED = "1996-03-01"

OUTCOMES = """
    SELECT CAST(claim_id AS VARCHAR) AS claim_id,
           CASE claim_id % 101 WHEN 0 THEN 'total_charge' WHEN 1 THEN 'claim_date'
                WHEN 2 THEN 'claim_date,total_charge' WHEN 3 THEN 'field count'
                ELSE 'loaded' END AS outcome
    FROM claims
"""


@query("ingest_rejects", OUTCOMES)
def ingest_rejects(t: StarTables) -> DataFrame:
    """A feed with damaged lines: each line ends up loaded, or rejected with its reason."""
    landing, target, log, rejects = (
        scratch_path(t.spark, x) for x in ("landing", "bronze", "log", "rejects")
    )
    names = [field.name for field in feeds.FEEDS["claims"]]
    damage = F.col("claim_id") % 101
    lines = t.claims().withColumns(
        {
            "claim_date": F.when(damage.isin(1, 2), F.date_format("claim_date", "dd/MM/yyyy"))
            .otherwise(F.col("claim_date").cast("string")),
            "total_charge": F.when(damage.isin(0, 2), "n/a")
            .otherwise(F.col("total_charge").cast("string")),
        }
    )
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    whole, cut = F.concat_ws(",", *texts), F.concat_ws(",", *texts[:3])
    # One column that holds whole lines, under a header that names the feed's columns.
    line = F.when(damage == 3, cut).otherwise(whole).alias(",".join(names))
    lines.select(line).write.options(header=True, sep="\t", quote="").csv(landing)
    schema = feeds.FEEDS["claims"]
    ingest_incremental(t.spark, landing, target, schema, log, rejects=rejects)
    loaded = read_ingested(t.spark, target, schema).select("claim_id", F.lit("loaded").alias("outcome"))
    bad = read_rejects(t.spark, rejects).select(
        F.split("record", ",")[0].alias("claim_id"), F.array_join("reasons", ",").alias("outcome")
    )
    return loaded.unionByName(bad)


def deliveries(t: StarTables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All feeds, but for late claims; then late claims, corrections, and dearer drug lines."""
    claims = t.claims()
    late = F.col("claim_date") >= as_date(LATE)
    month = F.trunc("claim_date", "month") == as_date(CORRECTED)
    corrected = claims.where(month).withColumn("total_charge", F.col("total_charge") + 1)
    lines = t.procedures()
    dearer = lines.where(F.col("claim_id") % 100 == 0).withColumn("amount", F.col("amount") + 1)
    first = {
        "members": t.members(),
        "claims": claims.where(~late),
        "providers": t.providers(),
        "procedures": lines,
    }
    # Rows that were delivered before come again, as feeds do.
    again = claims.where(month)
    second = {"claims": claims.where(late).unionByName(corrected).unionByName(again), "procedures": dearer}
    return first, second


def delivered(t: StarTables, reports: bool = False) -> tuple[Layers, list[dict[str, list]]]:
    """Both deliveries loaded and merged, partials too for reports; what each of them touched."""
    landing, bronze, loads, merged, root = (
        scratch_path(t.spark, x) for x in ("landing", "bronze", "loads", "merged", "tables")
    )
    layers = Layers(f"rxlens_{uuid.uuid4().hex[:12]}_", root)
    touched = []
    for drop in deliveries(t):
        for feed, df in drop.items():
            feeds.export_csv(df, f"{landing}/{feed}", mode="append", compression="gzip")
        load_bronze(t.spark, landing, bronze, loads)
        touched.append(update_silver(t.spark, bronze, layers, merged))
        if reports:
            update_gold(t.spark, layers, touched[-1])
    return layers, touched


DELIVERED = f"""
    delivered AS (
      SELECT DISTINCT claim_id, member_id, provider_id, claim_date,
             {half_up('total_charge')} AS total_charge, claim_status
      FROM (SELECT * FROM claims
            UNION ALL SELECT claim_id, member_id, provider_id, claim_date, total_charge + 1,
                             claim_status
            FROM claims WHERE date_trunc('month', claim_date) = DATE '{CORRECTED}')
      WHERE total_charge > 0)
"""


@query(
    "silver_incremental",
    f"""{DELIVERED}
    SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(member_id AS VARCHAR) AS member_id,
           CAST(provider_id AS VARCHAR) AS provider_id, claim_date, total_charge, claim_status,
           CAST(date_trunc('month', claim_date) AS DATE) AS claim_month
    FROM delivered
    """,
)
def silver_incremental(t: StarTables) -> DataFrame:
    """Silver claims after two deliveries; the second rewrites the months it has rows in."""
    layers, _ = delivered(t)
    return silver_tables(t.spark, layers)["claims"]


@query(
    "silver_lines_incremental",
    """
    lines AS (
      SELECT claim_id, procedure_code, procedure_desc, amount FROM procedures
      UNION ALL SELECT claim_id, procedure_code, procedure_desc, amount + 1 FROM procedures
      WHERE claim_id % 100 = 0),
    best AS (
      SELECT claim_id, procedure_code, max(amount) AS amount FROM lines WHERE amount > 0
      GROUP BY claim_id, procedure_code)
    SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(procedure_code AS VARCHAR) AS procedure_code,
           trim(min(procedure_desc)) AS procedure_desc, amount,
           CASE WHEN amount < 100 THEN 'Low' WHEN amount < 500 THEN 'Medium'
                WHEN amount < 1000 THEN 'High' ELSE 'Very High' END AS cost_category
    FROM best JOIN lines USING (claim_id, procedure_code, amount)
    GROUP BY claim_id, procedure_code, amount
    """,
)
def silver_lines_incremental(t: StarTables) -> DataFrame:
    """The best drug lines after a delivery with dearer ones."""
    layers, _ = delivered(t)
    return silver_tables(t.spark, layers)["procedures"]


BY_CHANNEL = """(SELECT c.*, p.specialty AS channel FROM delivered c
                 LEFT JOIN providers p USING (provider_id)) x"""


@query(
    "trend_incremental",
    f"""{DELIVERED.rstrip()},
    months AS ({month_totals(BY_CHANNEL, 'channel')}), {trend_sql('channel')}""",
)
def trend_incremental(t: StarTables) -> DataFrame:
    """The channel trend from stored partial aggregates, after two deliveries."""
    layers, _ = delivered(t, reports=True)
    reports = update_gold(t.spark, layers, {"claims": []})
    return reports["spend_trend_by_channel"]
