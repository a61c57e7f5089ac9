"""Silver and gold kept up to date by what a delivery touches.

``build_silver`` works out every table from all of bronze. Here a new load names the partitions
it has rows for: months of claims, buckets of a hashed key for the rest. Only these partitions
of the stored table are read, merged with the cleaned new rows and replaced; no older load is
read again. Every merge may be repeated without effect (distinct rows, the best line per key),
so a run that was cut short is simply run again, and a load that was merged twice changes
nothing.

Gold reports over claims start from partial aggregates: claims, cents, least and highest charge
and date range per month and pharmacy, stored by month. Months that a delivery touched are
aggregated anew from their silver partitions, and reports finish from the partials.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.functions import cents, first_of_month
from rxlens.operators.aggregates import resummarise, summarise
from rxlens.operators.reuse import checkpoint_stage
from rxlens.plans import gold, silver
from rxlens.plans.pipeline import Layers
from rxlens.sources.feeds import FEEDS
from rxlens.sources.layers import replace_partitions
from rxlens.streaming import read_ingested
from rxlens.streaming.ingest import LOAD_ID

#: Buckets of tables that have no month. Fixed for the life of a table.
BUCKETS = 64
#: Digits of the batch number at the end of a load id, and the dash before them.
BATCH_PART = 11


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Kept:
    """How a silver table is kept: rows of a load, and the state of old and new rows together.

    Rows that ``merge`` brings together agree in the partition and in ``keys``.
    """

    clean: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    part: str
    part_of: Callable[[int], Column]
    keys: tuple[str, ...]


KEPT: dict[str, Kept] = {
    "members": Kept(
        silver.silver_members,
        DataFrame.distinct,
        "member_bucket",
        lambda n: bucket_of("member_id", n),
        ("member_id",),
    ),
    "claims": Kept(
        silver.silver_claims,
        DataFrame.distinct,
        "claim_month",
        lambda n: first_of_month("claim_date"),
        ("claim_id",),
    ),
    "providers": Kept(
        silver.silver_providers,
        DataFrame.distinct,
        "provider_bucket",
        lambda n: bucket_of("provider_id", n),
        ("provider_id",),
    ),
    "procedures": Kept(
        silver.silver_procedures,
        lambda lines: silver.best_lines(lines, ["claim_bucket"]),
        "claim_bucket",
        lambda n: bucket_of("claim_id", n),
        ("claim_id", "procedure_code"),
    ),
}


def _done(spark: SparkSession, log: str) -> dict[str, str]:
    """The last merged load of every stream; load ids of a stream ascend."""
    try:
        loads = spark.read.schema(f"{LOAD_ID} STRING").parquet(log)
        stream = F.expr(f"left({LOAD_ID}, length({LOAD_ID}) - {BATCH_PART})")
        last = loads.groupBy(stream.alias("stream")).agg(F.max(LOAD_ID).alias("last"))
        return {r["stream"]: r["last"] for r in last.collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def new_loads(spark: SparkSession, bronze_feed: str, feed: str, log: str) -> DataFrame:
    """Rows of the loads that are not merged yet. Merged ones are skipped by their folders."""
    raw = read_ingested(spark, bronze_feed, FEEDS[feed])
    for stream, last in _done(spark, log).items():
        merged = F.startswith(LOAD_ID, F.lit(stream)) & (F.col(LOAD_ID) <= last)
        raw = raw.where(~merged)
    return raw


def update_silver(
    spark: SparkSession, bronze: str, layers: Layers, log: str, buckets: int = BUCKETS
) -> dict[str, list]:
    """Merge the new loads of every feed into its silver table.

    ``log`` is a folder that remembers merged loads, one list per feed. Returns the partition
    values that were replaced, per table; ``silver_tables`` reads the tables.
    """
    return {
        feed: _update(spark, bronze, layers, log, feed, kept, buckets)
        for feed, kept in KEPT.items()
    }


def _update(
    spark: SparkSession, bronze: str, layers: Layers, log: str, feed: str, kept: Kept, buckets: int
) -> list:
    fresh = new_loads(spark, f"{bronze}/{feed}", feed, f"{log}/{feed}")
    loads = fresh.select(LOAD_ID).distinct()
    # A row or two per delivery, from the folder names.
    ids = sorted(r[0] for r in loads.collect())
    if not ids:
        return []
    table, path = layers.place("silver", feed)
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    rows = kept.clean(fresh).withColumn(kept.part, kept.part_of(buckets))
    if spark.catalog.tableExists(table):
        rows = checkpoint_stage(rows)
        touched = _values(rows, kept.part)
        if touched:
            old = spark.table(table).where(_among(kept.part, touched))
            merged = kept.merge(_together(old, rows, kept))
            replace_partitions(merged, table, [kept.part], path, gathered=True)
    else:
        # Clean rows are the first state as they are.
        touched = _values(replace_partitions(rows, table, [kept.part], path), kept.part)
    noted = spark.range(1).select(F.explode(F.array(*map(F.lit, ids))).alias(LOAD_ID))
    noted.write.mode("append").parquet(f"{log}/{feed}")
    return touched


def _together(old: DataFrame, rows: DataFrame, kept: Kept) -> DataFrame:
    """Stored and new rows in one shuffle, which serves both the merge and the write.

    Both sides are clean, so a row meets few others, and nothing is gained by reducing them
    before the shuffle. Ranges of partition and key split a partition that is large.
    """
    every = old.select(*rows.columns).unionByName(rows)
    return every.repartitionByRange(kept.part, *kept.keys)


def _values(df: DataFrame, name: str) -> list:
    """The partition values of rows: at most one per partition of the table."""
    return sorted((r[0] for r in df.select(name).distinct().collect()), key=str)


def _among(name: str, values: list) -> Column:
    """Null-safe membership, as a filter on partitions."""
    known = [v for v in values if v is not None]
    hit = F.col(name).isin(known) if known else F.lit(False)
    return hit | F.col(name).isNull() if None in values else hit


def silver_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    """The stored tables; bucket columns are left out."""
    tables = {feed: spark.table(layers.place("silver", feed)[0]) for feed in KEPT}
    return {
        feed: df if feed == "claims" else df.drop(KEPT[feed].part) for feed, df in tables.items()
    }


# --- gold from partial aggregates ----------------------------------------------------------

PARTIALS = "claim_months"


def claim_partials(claims: DataFrame) -> DataFrame:
    """One row per month and pharmacy, with what merges: counts, cents, extremes."""
    return summarise(
        claims,
        ["claim_month", "provider_id"],
        {
            "claim_count": F.count(F.lit(1)),
            "cents": F.sum(cents("total_charge")),
            "least_charge": F.min("total_charge"),
            "highest_charge": F.max("total_charge"),
            "first_date": F.min("claim_date"),
            "last_date": F.max("claim_date"),
        },
    )


def merge_partials(partials: DataFrame, by: list[str]) -> DataFrame:
    """Partials of coarser groups."""
    return summarise(
        partials,
        by,
        {
            "claim_count": F.sum("claim_count"),
            "cents": F.sum("cents"),
            "least_charge": F.min("least_charge"),
            "highest_charge": F.max("highest_charge"),
            "first_date": F.min("first_date"),
            "last_date": F.max("last_date"),
        },
    )


def update_partials(spark: SparkSession, layers: Layers, months: list) -> DataFrame:
    """Aggregate the touched months of silver claims anew; the others keep their partials."""
    table, path = layers.place("gold", PARTIALS)
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    claims = spark.table(layers.place("silver", "claims")[0])
    if months or not spark.catalog.tableExists(table):
        wanted = claims.where(_among("claim_month", months))
        replace_partitions(claim_partials(wanted), table, ["claim_month"], path)
    return spark.table(table)


def reports_of_partials(partials: DataFrame, providers: DataFrame) -> dict[str, DataFrame]:
    """The reports over claims, months and pharmacies, without reading claims."""
    totals = partials.select("claim_month", "provider_id", "claim_count", "cents")
    months = resummarise(totals, ["claim_month"], ["claim_count", "cents"])
    channels = gold.channel_months_of_totals(totals, providers)
    return {
        "spend_trend": gold.trend(months),
        "spend_trend_by_channel": gold.trend(channels, ["channel"]),
        "spend_by_provider": gold.spend_of_totals(totals, providers),
        "channel_summary": gold.channels_of_totals(totals, providers),
    }


def update_gold(spark: SparkSession, layers: Layers, touched: Mapping[str, list]) -> dict[str, DataFrame]:
    """Reports after ``update_silver``, given the partitions that it replaced."""
    partials = update_partials(spark, layers, list(touched["claims"]))
    return reports_of_partials(partials, silver_tables(spark, layers)["providers"])
