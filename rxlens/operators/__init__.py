"""DataFrame operators: each takes and returns DataFrames and stays lazy."""

from rxlens.operators.aggregates import (
    count_when,
    freq,
    monthly,
    percentiles,
    resummarise,
    summarise,
    to_wide,
)
from rxlens.operators.joins import (
    broadcast_if_small,
    claims_enriched,
    drug_lines,
    in_subquery,
    join_default,
    lookup,
    members_in_plan,
    reconcile,
    with_lob,
    with_scalars,
)
from rxlens.operators.quality import (
    claim_rules,
    counted,
    dq_counts,
    enforce,
    mark_immature,
    orphans,
    schema_drift,
    stage_counts,
    tag_violations,
)
from rxlens.operators.reuse import cached, checkpoint_stage, shared_dir, stage_if_shared
from rxlens.operators.rows import align_and_union, append_all, dedup_best, top_k, typed
from rxlens.operators.tables import (
    apply_changes,
    apply_history,
    as_of,
    change_feed,
    delete_where,
    update_where,
    upsert,
)
from rxlens.operators.trend import (
    flag_anomalies,
    growth_pct,
    moving_avg,
    running_total,
    share_pct,
    share_shift,
    with_lag,
    with_lead,
)

__all__ = [
    "align_and_union",
    "append_all",
    "apply_changes",
    "apply_history",
    "as_of",
    "broadcast_if_small",
    "cached",
    "change_feed",
    "checkpoint_stage",
    "claim_rules",
    "claims_enriched",
    "count_when",
    "counted",
    "dedup_best",
    "delete_where",
    "dq_counts",
    "drug_lines",
    "enforce",
    "flag_anomalies",
    "freq",
    "growth_pct",
    "in_subquery",
    "join_default",
    "lookup",
    "mark_immature",
    "members_in_plan",
    "monthly",
    "moving_avg",
    "orphans",
    "percentiles",
    "reconcile",
    "resummarise",
    "running_total",
    "schema_drift",
    "share_pct",
    "share_shift",
    "shared_dir",
    "stage_counts",
    "stage_if_shared",
    "summarise",
    "tag_violations",
    "to_wide",
    "top_k",
    "typed",
    "update_where",
    "upsert",
    "with_lag",
    "with_lead",
    "with_lob",
    "with_scalars",
]
