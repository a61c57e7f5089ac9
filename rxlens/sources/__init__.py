"""Feeds in, layers out, and the star-schema adapter."""

from rxlens.sources.feeds import (
    FEEDS,
    export_csv,
    feed_inventory,
    ingest_full,
    read_feed,
    with_lineage,
)
from rxlens.sources.layers import compact, insert_rows, save_layer, write_history
from rxlens.sources.star import StarTables

__all__ = [
    "FEEDS",
    "StarTables",
    "compact",
    "export_csv",
    "feed_inventory",
    "ingest_full",
    "insert_rows",
    "read_feed",
    "save_layer",
    "with_lineage",
    "write_history",
]
