"""The whole way: feed folders to bronze, silver and gold tables.

Every table is stored and read back before the next layer uses it, so a layer is worked
out once and a lost executor costs no finished table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from rxlens.functions import first_of_month
from rxlens.plans import gold, silver
from rxlens.plans.gold import Day
from rxlens.sources.feeds import FEEDS, schema_once
from rxlens.sources.layers import save_layer
from rxlens.streaming import ingest_incremental, read_ingested

COMMENTS = {
    "members": "Enrollees, typed and distinct",
    "claims": "Claim headers with a positive charge, by month",
    "providers": "Pharmacies; specialty is the channel",
    "procedures": "Drug lines, the dearest per claim and drug",
    "member_lines": "Drug lines with member and date of their claim",
    "spend_by_provider": "Claims and spend per pharmacy",
    "channel_summary": "Claims and spend by channel and state",
    "spend_trend": "Monthly claims and spend with growth",
    "spend_trend_by_drug": "Monthly lines and amounts per drug with growth",
    "decision_volume": "Claims by month and decision",
    "approval_by_lob": "Approval rate by month and line of business",
    "high_cost_members": "Members at or above the 75th percentile of spend",
    "drug_type_mix": "Drug types by age band, gender and line of business",
    "pmpm": "Spend and claims per member month",
}


def load_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoints: str,
    inferred: Sequence[str] = (),
    rejects: str | None = None,
) -> dict[str, int]:
    """Load the new files of every feed folder under ``landing``; rows added per feed.

    ``inferred`` names further feeds, like diagnosis, that have no schema of their own: theirs
    is inferred at the first load, kept beside the checkpoint, and holds from then on. With
    ``rejects`` rows that do not parse go to a folder per feed below it instead of losing values.
    """
    schemas = dict(FEEDS)
    for feed in inferred:
        schemas[feed] = schema_once(spark, f"{landing}/{feed}", f"{checkpoints}/{feed}-schema")
    return {
        feed: ingest_incremental(
            spark,
            f"{landing}/{feed}",
            f"{bronze}/{feed}",
            schema,
            f"{checkpoints}/{feed}",
            rejects=None if rejects is None else f"{rejects}/{feed}",
        )
        for feed, schema in schemas.items()
    }


class Layers:
    """Where the tables go: databases of the catalog, names with an optional prefix.

    With ``root`` the files lie under that folder, otherwise in the warehouse.
    """

    def __init__(self, prefix: str = "", root: str | None = None) -> None:
        self.prefix = prefix
        self.root = root

    def place(self, layer: str, name: str) -> tuple[str, str | None]:
        """Full table name, and the folder of its files if not in the warehouse."""
        table = f"{self.prefix}{name}"
        return f"{layer}.{table}", None if self.root is None else f"{self.root}/{layer}/{table}"

    def save(
        self, df: DataFrame, layer: str, name: str, partition_by: str | None = None
    ) -> DataFrame:
        table, path = self.place(layer, name)
        table = table.split(".")[1]
        return save_layer(
            df, layer, table, partition_by=partition_by, comment=COMMENTS[name], path=path
        )


def build_silver(
    spark: SparkSession, bronze: str, layers: Layers | None = None
) -> dict[str, DataFrame]:
    """Clean every loaded feed. Claims are partitioned by month for date filters."""
    layers = layers or Layers()
    raw = {feed: read_ingested(spark, f"{bronze}/{feed}", FEEDS[feed]) for feed in FEEDS}
    claims = silver.silver_claims(raw["claims"])
    return {
        "members": layers.save(silver.silver_members(raw["members"]), "silver", "members"),
        "claims": layers.save(
            claims.withColumn("claim_month", first_of_month("claim_date")),
            "silver",
            "claims",
            partition_by="claim_month",
        ),
        "providers": layers.save(silver.silver_providers(raw["providers"]), "silver", "providers"),
        "procedures": layers.save(
            silver.silver_procedures(raw["procedures"]), "silver", "procedures"
        ),
    }


def build_gold(
    tables: Mapping[str, DataFrame],
    as_of: Day,
    start: Day,
    end: Day,
    layers: Layers | None = None,
) -> dict[str, DataFrame]:
    """Build the reports from silver tables; ``start`` and ``end`` bound the member months.

    The join of claims and lines is stored once for the three reports that start from it.
    """
    layers = layers or Layers()
    claims, members, providers = tables["claims"], tables["members"], tables["providers"]
    lines = layers.save(gold.member_lines(claims, tables["procedures"]), "gold", "member_lines")
    reports = {
        "spend_by_provider": gold.spend_by_provider(claims, providers),
        "channel_summary": gold.channel_summary(claims, providers),
        "spend_trend": gold.spend_trend(claims),
        "decision_volume": gold.decision_volume(claims, members),
        "approval_by_lob": gold.approval_by_lob(claims, members),
        "spend_trend_by_drug": gold.spend_trend_by_drug(lines, ordered=False),
        "high_cost_members": gold.high_cost_members(claims, lines, members, as_of, ordered=False),
        "drug_type_mix": gold.drug_type_mix(lines, members, as_of),
        "pmpm": gold.pmpm(claims, members, start, end),
    }
    return {name: layers.save(df, "gold", name) for name, df in reports.items()}
