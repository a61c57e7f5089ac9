"""Fixed values.

Labels, cut points and patterns that results must carry exactly as they stand here.
"""

# --- fixed values: number bands, each band is [previous cut, cut) -------------------
COST_CUTS = (100, 500, 1000)
COST_LABELS = ("Low", "Medium", "High", "Very High")

RISK_CUTS = (1000, 5000)
RISK_LABELS = ("Low", "Medium", "High")

AGE_CUTS = (18, 35, 50, 65)
AGE_LABELS = ("0-17", "18-34", "35-49", "50-64", "65+")

DRUG_TYPE_CUTS = (100, 1000)
DRUG_TYPE_LABELS = ("Generic (proxy)", "Brand (proxy)", "Specialty (proxy)")

# --- fixed values: tiers, reached at or above the threshold --------------------------
SPEND_TIERS = (
    ("p95_threshold", "Tier 1 — Critical (95th+ pct)"),
    ("p90_threshold", "Tier 2 — High (90th-95th pct)"),
    ("p75_threshold", "Tier 3 — Moderate (75th-90th pct)"),
)
SPEND_TIER_DEFAULT = "Tier 4 — Standard"
SPEND_POINTS = {"p95_threshold": 0.95, "p90_threshold": 0.90, "p75_threshold": 0.75}

POLYPHARMACY_TIERS = (
    (10, "Polypharmacy — Refer to clinical review"),
    (5, "Watch list"),
)
POLYPHARMACY_DEFAULT = "Standard"

CREDIBILITY_TIERS = (
    (1000, "Full credibility"),
    (500, "Partial credibility"),
    (100, "Limited credibility"),
)
CREDIBILITY_DEFAULT = "Low credibility"

# --- fixed values: codes, statuses, patterns -----------------------------------------
CHANNEL_CODES = {"R": "Retail", "M": "Mail Order", "S": "Specialty"}
UNKNOWN_LABEL = "Unknown"
#: Codec of stored Parquet files.
CODEC = "zstd"
DECISION_STATUSES = ("APPROVED", "DENIED", "PENDING")
AMOUNT_NOISE = "[^0-9.]"
SIGNED_AMOUNT_NOISE = "[^0-9.-]"
