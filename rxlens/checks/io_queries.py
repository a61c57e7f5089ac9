"""Sources and sinks: whole tables written as feeds or layers, and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.checks.gold_queries import CHANNEL_SUMMARY, MONTHS
from rxlens.checks.registry import query
from rxlens.functions import as_date, first_of_month
from rxlens.operators.quality import counted
from rxlens.operators.reuse import checkpoint_stage, scratch_path
from rxlens.operators.rows import align_and_union
from rxlens.plans.pipeline import Layers, build_gold, build_silver, load_bronze
from rxlens.sources import feeds, layers
from rxlens.sources.star import AS_OF, StarTables
from rxlens.streaming import ingest_incremental, read_ingested
from rxlens.streaming.ingest import LOAD_ID

SPLIT = "1999-01-01"
CHECK_TABLE = "rxlens_check_claims_by_month"

FEED_ROWS = """
    SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(member_id AS VARCHAR) AS member_id,
           CAST(provider_id AS VARCHAR) AS provider_id, claim_date, total_charge, claim_status
    FROM claims
"""


def claims_feed(t: StarTables) -> DataFrame:
    """Claims in the types of the raw feed."""
    schema = feeds.FEEDS["claims"]
    return t.claims().select(*[F.col(f.name).cast(f.dataType) for f in schema])


def drops(t: StarTables) -> tuple[DataFrame, DataFrame]:
    """The feed as two deliveries."""
    feed = claims_feed(t)
    early = F.col("claim_date") < as_date(SPLIT)
    return feed.where(early), feed.where(~early)


@query("read_feed", FEED_ROWS)
def read_feed(t: StarTables) -> DataFrame:
    """Export as CSV with a header and read with the feed's schema."""
    path = scratch_path(t.spark, "feed")
    feeds.export_csv(claims_feed(t), path)
    return feeds.read_feed(t.spark, path, feeds.FEEDS["claims"])


@query(
    "read_feed_inferred",
    "SELECT claim_id, member_id, claim_date, total_charge, claim_status FROM claims",
)
def read_feed_inferred(t: StarTables) -> DataFrame:
    """CSV types found by inspection; ids come back as numbers."""
    path = scratch_path(t.spark, "feed")
    feeds.export_csv(claims_feed(t).drop("provider_id"), path)
    found = feeds.read_feed(t.spark, path)
    return found.withColumns({name: F.col(name).cast("bigint") for name in ("claim_id", "member_id")})


@query("json_scan", FEED_ROWS)
def json_scan(t: StarTables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    claims_feed(t).write.json(path)
    return t.spark.read.schema(feeds.FEEDS["claims"]).json(path)


@query("parquet_scan", "SELECT * FROM orders")
def parquet_scan(t: StarTables) -> DataFrame:
    return t.table("orders")


@query("ingest_incremental", FEED_ROWS)
def incremental(t: StarTables) -> DataFrame:
    """Two deliveries; a load between them finds nothing new and adds nothing."""
    landing, target, log = (scratch_path(t.spark, x) for x in ("landing", "bronze", "log"))
    schema = feeds.FEEDS["claims"]
    for drop in drops(t):
        feeds.export_csv(drop, landing, mode="append")
        ingest_incremental(t.spark, landing, target, schema, log)
        again = ingest_incremental(t.spark, landing, target, schema, log)
        if again:
            raise AssertionError(f"second load added {again} rows")
    return read_ingested(t.spark, target).drop(LOAD_ID)


@query(
    "ingest_projection",
    "SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(year(claim_date) AS INTEGER) AS yr FROM claims",
)
def projection(t: StarTables) -> DataFrame:
    landing, target, log = (scratch_path(t.spark, x) for x in ("landing", "bronze", "log"))
    feeds.export_csv(claims_feed(t), landing)
    ingest_incremental(
        t.spark,
        landing,
        target,
        feeds.FEEDS["claims"],
        log,
        transform=lambda feed: feed.select("claim_id", F.year("claim_date").alias("yr")),
    )
    return read_ingested(t.spark, target).drop(LOAD_ID)


@query("ingest_json", FEED_ROWS)
def json_feed(t: StarTables) -> DataFrame:
    landing, target, log = (scratch_path(t.spark, x) for x in ("landing", "bronze", "log"))
    claims_feed(t).write.json(landing)
    schema = feeds.FEEDS["claims"]
    ingest_incremental(t.spark, landing, target, schema, log, file_format="json")
    return read_ingested(t.spark, target).drop(LOAD_ID)


@query("ingest_parquet", "SELECT * FROM lineitem")
def parquet_feed(t: StarTables) -> DataFrame:
    landing, target, log = (scratch_path(t.spark, x) for x in ("landing", "bronze", "log"))
    lines = t.table("lineitem")
    lines.write.parquet(landing)
    ingest_incremental(t.spark, landing, target, lines.schema, log, file_format="parquet")
    return read_ingested(t.spark, target).drop(LOAD_ID)


@query(
    "ingest_full",
    f"{FEED_ROWS} UNION ALL {FEED_ROWS}",
)
def full_reload(t: StarTables) -> DataFrame:
    """A forced load appends every file again."""
    landing, target = (scratch_path(t.spark, x) for x in ("landing", "bronze"))
    schema = feeds.FEEDS["claims"]
    feeds.export_csv(claims_feed(t), landing)
    feeds.ingest_full(t.spark, landing, target, schema)
    feeds.ingest_full(t.spark, landing, target, schema, mode="append")
    return t.spark.read.parquet(target)


@query(
    "align_and_union",
    f"""
    SELECT claim_id, claim_date, total_charge,
           CASE WHEN claim_date >= DATE '{SPLIT}' THEN claim_status END AS claim_status
    FROM claims
    """,
)
def evolving_feed(t: StarTables) -> DataFrame:
    """The later feed has a column that the earlier one lacked."""
    claims = t.claims(with_provider=False).drop("member_id")
    early = F.col("claim_date") < as_date(SPLIT)
    return align_and_union(claims.where(early).drop("claim_status"), claims.where(~early))


TABLES = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


@query(
    "feed_inventory",
    " UNION ALL ".join(f"SELECT '{x}' AS feed, count(*) AS row_count FROM {x}" for x in TABLES),
)
def feed_inventory(t: StarTables) -> DataFrame:
    """Rows per feed, added up over the feed's files."""
    counts = [
        feeds.feed_inventory(t.table(name))
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.lit(name).alias("feed"), "row_count")
        for name in TABLES
    ]
    whole = counts[0]
    for one in counts[1:]:
        whole = whole.unionByName(one)
    return whole


@query(
    "with_lineage",
    "SELECT claim_status, count(*) AS claims, count(*) AS with_source FROM claims GROUP BY ALL",
)
def lineage(t: StarTables) -> DataFrame:
    path = scratch_path(t.spark, "lineage")
    t.claims(with_provider=False).write.parquet(path)
    tagged = feeds.with_lineage(t.spark.read.parquet(path))
    files = t.spark.read.parquet(path).select(F.col("_metadata.file_name").alias("source_file"))
    known = tagged.join(files.distinct(), "source_file", "left_semi")
    counts = known.groupBy("claim_status").agg(F.count(F.lit(1)).alias("with_source"))
    every = tagged.groupBy("claim_status").agg(F.count(F.lit(1)).alias("claims"))
    return every.join(counts, every["claim_status"].eqNullSafe(counts["claim_status"])).select(
        every["claim_status"], "claims", "with_source"
    )


@query(
    "save_layer",
    """
    SELECT claim_id, claim_status, CAST(date_trunc('month', claim_date) AS DATE) AS claim_month
    FROM claims
    """,
)
def stored_layer(t: StarTables) -> DataFrame:
    """Create or replace a table partitioned by month, append to it, and scan it."""
    claims = t.claims(with_provider=False).select(
        "claim_id", "claim_status", first_of_month("claim_date").alias("claim_month")
    )
    early = F.col("claim_month") < as_date(SPLIT)
    options = {
        "partition_by": "claim_month",
        "path": scratch_path(t.spark, "layer"),
        "comment": "Claims by month",
    }
    layers.save_layer(claims.where(early), "silver", CHECK_TABLE, **options)
    layers.save_layer(claims.where(~early), "silver", CHECK_TABLE, mode="append", **options)
    return t.spark.table(f"silver.{CHECK_TABLE}")


@query(
    "stored_view",
    """
    SELECT claim_status, count(*) AS claims FROM claims GROUP BY claim_status
    """,
)
def stored_view(t: StarTables) -> DataFrame:
    """A permanent view over a stored table."""
    claims = t.claims(with_provider=False).select("claim_id", "claim_status")
    layers.save_layer(claims, "silver", "rxlens_check_status", path=scratch_path(t.spark, "layer"))
    t.spark.sql(
        """
        CREATE OR REPLACE VIEW silver.rxlens_check_status_counts AS
        SELECT claim_status, count(claim_id) AS claims FROM silver.rxlens_check_status GROUP BY ALL
        """
    )
    return t.spark.table("silver.rxlens_check_status_counts")


@query(
    "observed_write",
    "SELECT *, (SELECT count(*) FROM claims) AS rows_written FROM claims",
)
def observed_write(t: StarTables) -> DataFrame:
    """Count rows while they are written, without another pass."""
    watched, seen = counted(t.claims(), "claims")
    stored = checkpoint_stage(watched)
    return stored.withColumn("rows_written", F.lit(seen.get["row_count"]).cast("bigint"))


@query(
    "insert_rows",
    """
    SELECT n_nationkey, n_name FROM nation UNION ALL SELECT -1, 'UNKNOWN'
    """,
)
def literal_rows(t: StarTables) -> DataFrame:
    nations = t.table("nation").select("n_nationkey", "n_name")
    path = scratch_path(t.spark, "layer")
    layers.save_layer(nations, "bronze", "rxlens_check_nations", path=path)
    layers.insert_rows(t.spark, "bronze.rxlens_check_nations", [(-1, "UNKNOWN")])
    return t.spark.table("bronze.rxlens_check_nations")


@query("compact", "SELECT * FROM orders")
def compacted(t: StarTables) -> DataFrame:
    """A table written by two loads, rewritten in order of member and date."""
    src, path = scratch_path(t.spark, "loads"), scratch_path(t.spark, "compact")
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    for load in (early, ~early):
        t.table("orders").where(load).write.mode("append").parquet(src)
    return layers.compact(t.spark, src, path, cluster_by=["o_custkey", "o_orderdate"])


@query(
    "write_history",
    f"""
    SELECT claim_id, claim_status, DATE '{SPLIT}' AS batch_ts FROM claims
    WHERE claim_date < DATE '{SPLIT}'
    UNION ALL SELECT claim_id, claim_status, DATE '2001-12-31' FROM claims
    WHERE claim_date >= DATE '{SPLIT}'
    """,
)
def stored_history(t: StarTables) -> DataFrame:
    """Two batches in a history table; the second is written twice."""
    path = scratch_path(t.spark, "history")
    first, second = (drop.select("claim_id", "claim_status") for drop in drops(t))
    layers.write_history(first, path, dt.date.fromisoformat(SPLIT))
    for _ in range(2):
        layers.write_history(second, path, dt.date(2001, 12, 31))
    stored = t.spark.read.parquet(path)
    return stored.withColumn("claim_id", F.col("claim_id").cast("bigint"))


def medallion(t: StarTables) -> dict[str, DataFrame]:
    """All feeds as CSV drops, loaded, cleaned and turned into stored reports."""
    landing, bronze, log, root = (
        scratch_path(t.spark, x) for x in ("landing", "bronze", "log", "tables")
    )
    sources = {
        "members": t.members(),
        "claims": t.claims(),
        "providers": t.providers(),
        "procedures": t.procedures(),
    }
    for feed, df in sources.items():
        feeds.export_csv(df, f"{landing}/{feed}", compression="gzip")
    load_bronze(t.spark, landing, bronze, log)
    layers_at = Layers("rxlens_check_", root)
    silver = build_silver(t.spark, bronze, layers_at)
    return build_gold(silver, AS_OF, *MONTHS, layers_at)


@query("medallion_channels", f"{CHANNEL_SUMMARY} SELECT * FROM channel_summary")
def medallion_channels(t: StarTables) -> DataFrame:
    """The channel report at the end of the whole way from CSV files."""
    return medallion(t)["channel_summary"]


@query("checkpoint_stage", "SELECT * FROM claims")
def staged(t: StarTables) -> DataFrame:
    return checkpoint_stage(t.claims())
