"""A session with the settings these jobs expect. A session of your own works as well."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are compared with dates; keep timestamps out of the local zone.
    "spark.sql.session.timeZone": "UTC",
    # Split hot join partitions and merge small ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Without the Python call site in error texts, building a large expression is
    # several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str, master: str | None = None, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """Start or get a session. ``settings`` adds to, or replaces, the ones above."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in (SETTINGS | dict(settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
