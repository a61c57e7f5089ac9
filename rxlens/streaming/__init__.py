"""Incremental load of feed folders."""

from rxlens.streaming.ingest import ingest_incremental, read_ingested, read_rejects

__all__ = ["ingest_incremental", "read_ingested", "read_rejects"]
