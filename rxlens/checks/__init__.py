"""Registered queries, each beside the SQL that must give the same rows."""

from rxlens.checks import (  # noqa: F401
    gold_queries,
    incremental_queries,
    io_queries,
    operator_queries,
    silver_queries,
)
from rxlens.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
