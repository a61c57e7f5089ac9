"""Silver tables: raw feeds cleaned, typed and de-duplicated.

Rows are distinct as a whole, so two versions of a member both survive; use
``dedup_best`` on the key where one row per key is wanted. Filters come before the
``distinct``, which combines equal rows within each map task before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.functions import band, clean_amount, norm_code
from rxlens.operators.rows import dedup_best, typed
from rxlens.values import COST_CUTS, COST_LABELS


def silver_members(raw: DataFrame) -> DataFrame:
    present = raw.where(F.col("member_id").isNotNull())
    return (
        typed(present, {"member_id": "string", "birth_date": "date", "effective_date": "date"})
        .select(
            "member_id",
            F.trim("first_name").alias("first_name"),
            F.trim("last_name").alias("last_name"),
            "birth_date",
            "gender",
            "plan_id",
            "effective_date",
        )
        .distinct()
    )


def silver_claims(raw: DataFrame) -> DataFrame:
    """The charge is tested before it is rounded, so a tiny one may come out as 0.00.

    ``member_id`` becomes text as in the members table, so that the two can be joined.
    """
    billed = raw.where(F.col("claim_id").isNotNull() & (F.col("total_charge") > 0))
    return (
        typed(billed, {"member_id": "string", "claim_date": "date"})
        .select(
            "claim_id",
            "member_id",
            "provider_id",
            "claim_date",
            F.round("total_charge", 2).alias("total_charge"),
            F.lower("claim_status").alias("claim_status"),
        )
        .distinct()
    )


def silver_providers(raw: DataFrame) -> DataFrame:
    return (
        raw.where(F.col("provider_id").isNotNull())
        .select("provider_id", "npi", "provider_name", "specialty", "address", "city", "state")
        .distinct()
    )


def silver_procedures(raw: DataFrame, keep_sign: bool = False) -> DataFrame:
    """Drug lines with a clean amount, one per claim and drug: the dearest, then by text.

    The amount is tested after the best line is picked. That keeps the same lines, as the
    best line fails the test only if all of its key's lines do, and the amount is parsed
    once per line, not once more in a filter.
    """
    lines = raw.where(F.col("claim_id").isNotNull()).select(
        "claim_id",
        norm_code("procedure_code").alias("procedure_code"),
        F.trim("procedure_desc").alias("procedure_desc"),
        clean_amount("amount", keep_sign).alias("amount"),
    )
    best = best_lines(lines).where(F.col("amount") > 0)
    return best.withColumn("cost_category", band("amount", COST_CUTS, COST_LABELS))


def best_lines(lines: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """One line per claim and drug. Best lines of several deliveries merge by the same rule.

    ``also`` names columns that the claim determines; lines that lie together by them are not
    shuffled again.
    """
    return dedup_best(
        lines,
        [*also, "claim_id", "procedure_code"],
        [F.desc("amount"), F.asc("procedure_desc")],
    )
