"""Time the headline reports and print one JSON line.

Each query is run to the end into Spark's ``noop`` sink, so every column is worked out and
nothing is collected. The figure per query is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rxlens.checks import QUERIES
from rxlens.session import get_session

HEADLINE = (
    "channel_summary",
    "spend_by_provider",
    "spend_trend",
    "spend_trend_by_lob",
    "spend_trend_by_channel",
    "decision_volume",
    "approval_by_lob",
    "member_percentiles",
    "high_cost_members",
    "drug_type_mix",
    "pmpm",
    "pre_post",
    "silver_claims",
    "silver_procedures",
    "claims_enriched",
    "upsert",
    "change_feed",
    "spend_trend_by_drug",
    "top_members",
    "medallion_channels",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [name for name in chosen if name] or HEADLINE
    spark = get_session(
        "rxlens-bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline reports, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
