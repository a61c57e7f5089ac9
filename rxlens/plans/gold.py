"""Gold tables: the reports built from silver entities.

Amounts are expected with at most two decimals, as silver leaves them. Facts are reduced
before they meet a dimension wherever the aggregate allows it, so a pharmacy or member
with a large part of all rows shrinks to a few rows inside each map task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.functions import (
    age_year_diff,
    as_date,
    average_money,
    band,
    cents,
    days_since,
    dollars,
    first_of_month,
    growth,
    rate_pct,
    ratio,
    tier,
    total_money,
)
from rxlens.operators.aggregates import count_when, monthly, percentiles, resummarise, summarise
from rxlens.operators.joins import in_subquery, join_default, with_lob, with_scalars
from rxlens.operators.reuse import stage_if_shared
from rxlens.operators.rows import dedup_best
from rxlens.operators.trend import moving_avg, prior_value, share_pct
from rxlens.values import (
    AGE_CUTS,
    AGE_LABELS,
    CREDIBILITY_DEFAULT,
    CREDIBILITY_TIERS,
    DECISION_STATUSES,
    DRUG_TYPE_CUTS,
    DRUG_TYPE_LABELS,
    POLYPHARMACY_DEFAULT,
    POLYPHARMACY_TIERS,
    SPEND_POINTS,
    SPEND_TIER_DEFAULT,
    SPEND_TIERS,
)

Day = dt.date | str


def _rows() -> Column:
    return F.count(F.lit(1))


# --- spend by pharmacy and channel -------------------------------------------------------


def _provider_totals(claims: DataFrame, *also: Column | str) -> DataFrame:
    """Claims reduced to one row per pharmacy before any join."""
    return summarise(
        claims,
        ["provider_id", *also],
        {"claim_count": _rows(), "cents": F.sum(cents("total_charge"))},
    )


def spend_by_provider(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims and spend per pharmacy; claims without a known pharmacy form a NULL row."""
    return spend_of_totals(_provider_totals(claims), providers)


def spend_of_totals(totals: DataFrame, providers: DataFrame) -> DataFrame:
    """``spend_by_provider`` from ``claim_count`` and ``cents`` per pharmacy (and month, say)."""
    known = providers.select(
        "provider_id",
        F.col("provider_id").alias("pharmacy_id"),
        F.col("provider_name").alias("pharmacy_name"),
        F.col("specialty").alias("channel"),
    )
    joined = totals.join(known, "provider_id", "left")
    return summarise(
        joined,
        ["pharmacy_id", "pharmacy_name", "channel"],
        {"claim_count": F.sum("claim_count"), "total_drug_spend": dollars(F.sum("cents"))},
    ).orderBy(F.desc("total_drug_spend"), "pharmacy_id")


def channel_summary(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims, spend and spend per claim by channel and state, NULL group included."""
    return channels_of_totals(_provider_totals(claims), providers)


def channels_of_totals(totals: DataFrame, providers: DataFrame) -> DataFrame:
    """``channel_summary`` from ``claim_count`` and ``cents`` per pharmacy (and month, say)."""
    places = providers.select("provider_id", F.col("specialty").alias("channel"), "state")
    joined = totals.join(places, "provider_id", "left")
    return summarise(
        joined,
        ["channel", "state"],
        {
            "claim_count": F.sum("claim_count"),
            "total_drug_spend": dollars(F.sum("cents")),
            "avg_spend_per_claim": ratio(F.sum("cents"), F.sum("claim_count") * 100),
        },
    ).orderBy(F.desc("total_drug_spend"), "channel", "state")


def channel_summary_ranked(
    summary: DataFrame, by: Sequence[str] = ("channel", "state")
) -> DataFrame:
    """The channel summary aggregated again, by spend. Averages of averages are unweighted."""
    return resummarise(
        summary, by, ["claim_count", "total_drug_spend"], ["avg_spend_per_claim"]
    ).orderBy(F.desc("total_drug_spend"), *by)


# --- trends ------------------------------------------------------------------------------


def month_totals(
    df: DataFrame, by: Sequence[str] = (), date: str = "claim_date", amount: str = "total_charge"
) -> DataFrame:
    """One row per month and key: row count, and spend in cents."""
    return monthly(
        df, date, by, {"claim_count": _rows(), "cents": F.sum(cents(amount))}
    )


def trend(
    months: DataFrame, by: Sequence[str] = (), calendar: bool = False, ordered: bool = True
) -> DataFrame:
    """Growth and smoothing over ``month_totals``.

    ``calendar=False`` looks one and twelve *rows* back; ``calendar=True`` one and twelve
    months, which differs when a month is missing. ``ordered=False`` saves the sort, by month
    and key, where the result is stored anyway.
    """
    order, spend = "claim_month", "total_drug_spend"
    with_spend = months.withColumns(
        {
            spend: dollars("cents"),
            "avg_spend_per_claim": ratio("cents", F.col("claim_count") * 100),
        }
    )
    smoothed = moving_avg(with_spend, order, spend, 3, by, "moving_avg_3mo")
    prior = smoothed.withColumns(
        {
            "prior_month_spend": prior_value(order, spend, 1, by, calendar),
            "prior_year_spend": prior_value(order, spend, 12, by, calendar),
        }
    )
    found = prior.select(
        order,
        *by,
        "claim_count",
        spend,
        "avg_spend_per_claim",
        "prior_month_spend",
        growth(spend, "prior_month_spend").alias("mom_growth_pct"),
        "prior_year_spend",
        growth(spend, "prior_year_spend").alias("yoy_growth_pct"),
        "moving_avg_3mo",
    )
    return found.orderBy(order, *by) if ordered else found


def spend_trend(claims: DataFrame, by: Sequence[str] = (), calendar: bool = False) -> DataFrame:
    """Monthly claims and spend with growth, overall or per key of ``claims``."""
    return trend(month_totals(claims, by), by, calendar)


def channel_months(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """``month_totals`` per channel, from totals per pharmacy and month."""
    return channel_months_of_totals(month_totals(claims, ["provider_id"]), providers)


def channel_months_of_totals(totals: DataFrame, providers: DataFrame) -> DataFrame:
    """``channel_months`` from ``month_totals`` per pharmacy."""
    places = providers.select("provider_id", F.col("specialty").alias("channel"))
    joined = totals.join(places, "provider_id", "left")
    return resummarise(joined, ["claim_month", "channel"], ["claim_count", "cents"])


def spend_trend_by_channel(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Monthly trend per channel."""
    return trend(channel_months(claims, providers), ["channel"])


def spend_trend_by_drug(lines: DataFrame, ordered: bool = True) -> DataFrame:
    """Monthly trend per drug code over ``member_lines``, in line items and their amounts."""
    months = month_totals(lines, ["procedure_code"], amount="amount")
    return trend(months, ["procedure_code"], ordered=ordered)


def membership_trend(
    members: DataFrame, start: Day, end: Day, by: Sequence[str] = ("plan_id",)
) -> DataFrame:
    """Active members per month and key, with month-over-month and yearly growth."""
    active = member_months(members, start, end, by)
    before = {
        "prior_month_members": prior_value("member_month", "member_months", 1, by),
        "prior_year_members": prior_value("member_month", "member_months", 12, by),
    }
    return (
        active.withColumns(before)
        .withColumns(
            {
                "mom_growth_pct": growth("member_months", "prior_month_members"),
                "yoy_growth_pct": growth("member_months", "prior_year_members"),
            }
        )
        .orderBy("member_month", *by)
    )


# --- decisions -----------------------------------------------------------------------------


def _decisions(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Claims of known members by member, month and upper-case status, before the members join.

    Days since enrolment are kept as a sum: the claims' day numbers, less one enrolment day
    per dated claim.
    """
    reduced = summarise(
        claims.select(
            "member_id",
            first_of_month("claim_date").alias("claim_month"),
            F.upper("claim_status").alias("decision_status"),
            cents("total_charge").alias("charge"),
            F.unix_date("claim_date").alias("day"),
        ),
        ["member_id", "claim_month", "decision_status"],
        {
            "claims": _rows(),
            "cents": F.sum("charge"),
            "days": F.sum("day"),
            "dated": F.count("day"),
        },
    )
    enrolled = F.unix_date("effective_date")
    return with_lob(reduced, members).select(
        "claim_month",
        "lob",
        "decision_status",
        "claims",
        "cents",
        (F.col("days") - F.col("dated") * enrolled).alias("turnaround"),
        F.when(enrolled.isNotNull(), F.col("dated")).otherwise(0).alias("timed"),
    )


def _mean_turnaround() -> Column:
    return ratio(F.sum("turnaround"), F.sum("timed"), 1)


def decision_volume(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Claims by month and decision, with the share of the month."""
    volume = summarise(
        _decisions(claims, members),
        ["claim_month", "decision_status"],
        {
            "claim_count": F.sum("claims"),
            "total_drug_spend": dollars(F.sum("cents")),
            "avg_turnaround_days_proxy": _mean_turnaround(),
        },
    )
    return share_pct(volume, "claim_count", ["claim_month"], "pct_of_month").orderBy(
        "claim_month", "decision_status"
    )


def approval_rate(volume: DataFrame) -> DataFrame:
    """Decision volume rolled up by month. Other statuses count in the total only."""
    counts = count_when(
        volume,
        ["claim_month"],
        "decision_status",
        {status.lower(): status for status in DECISION_STATUSES},
        total="total_claims",
        weight="claim_count",
    )
    return counts.withColumn("approval_rate_pct", rate_pct("approved", "total_claims")).orderBy(
        "claim_month"
    )


def approval_by_lob(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Approval rate and turnaround by month and line of business, over all claims."""

    def having(status: str) -> Column:
        return F.sum(F.when(F.col("decision_status") == status, F.col("claims")).otherwise(0))

    approved, denied, _ = DECISION_STATUSES
    every = F.sum("claims")
    return summarise(
        _decisions(claims, members),
        ["claim_month", "lob"],
        {
            "total_claims": every,
            "approved": having(approved),
            "denied": having(denied),
            "approval_rate_pct": rate_pct(having(approved), every),
            "avg_turnaround_days_proxy": _mean_turnaround(),
        },
    ).orderBy("claim_month", "lob")


# --- members and drugs ---------------------------------------------------------------------


def member_summary(claims: DataFrame) -> DataFrame:
    """Claims, spend and fill dates per member."""
    return summarise(
        claims,
        ["member_id"],
        {
            "claim_count": F.count("claim_id"),
            "total_drug_spend": total_money("total_charge"),
            "avg_spend_per_claim": average_money("total_charge"),
            "first_fill_date": F.min("claim_date"),
            "last_fill_date": F.max("claim_date"),
            "years_with_fills": F.count_distinct(F.year("claim_date")),
        },
    )


def member_percentiles(summary: DataFrame, exact: bool = True) -> DataFrame:
    """Spend thresholds over members, one row.

    Two decimals of a fraction times whole cents fill four decimals, so rounding there
    only removes floating-point noise from the comparison with a member's spend.
    """
    found = percentiles(summary, "total_drug_spend", SPEND_POINTS, exact)
    return found.select(*[F.round(name, 4).alias(name) for name in SPEND_POINTS])


def member_lines(claims: DataFrame, procedures: DataFrame) -> DataFrame:
    """Drug lines with member and date of their claim.

    This joins the two largest tables, and several reports start from it: store it once
    where more than one of them is built. A report that does not reads only its columns.
    """
    headers = claims.select("claim_id", "member_id", "claim_date")
    return headers.join(procedures.select("claim_id", "procedure_code", "amount"), "claim_id")


def distinct_drugs(lines: DataFrame) -> DataFrame:
    """Different drugs per member."""
    return summarise(lines, ["member_id"], {"distinct_drugs": F.count_distinct("procedure_code")})


def high_cost_members(
    claims: DataFrame,
    lines: DataFrame,
    members: DataFrame,
    as_of: Day,
    exact: bool = True,
    ordered: bool = True,
    stage: Callable[[DataFrame], DataFrame] = stage_if_shared,
) -> DataFrame:
    """Members at or above the 75th percentile of spend, with tier and drug count.

    ``lines`` are ``member_lines``. The member summary feeds the thresholds and the result; ``stage`` decides whether it
    is written in between. Only members above the lowest threshold reach the joins.
    ``ordered=False`` saves the sort, by spend, when the result is stored or cut to a
    top list anyway.
    """
    summary = stage(member_summary(claims))
    costly = with_scalars(summary, member_percentiles(summary, exact)).where(
        F.col("total_drug_spend") >= F.col("p75_threshold")
    )
    theirs = in_subquery(lines, costly, "member_id")
    counted = join_default(costly, distinct_drugs(theirs), "member_id", {"distinct_drugs": 0})
    people = members.select(
        "member_id", "first_name", "last_name", "gender", "birth_date", "plan_id"
    )
    found = counted.join(people, "member_id").select(
        "member_id",
        "claim_count",
        "total_drug_spend",
        "avg_spend_per_claim",
        "first_fill_date",
        "last_fill_date",
        "years_with_fills",
        "distinct_drugs",
        tier("total_drug_spend", SPEND_TIERS, SPEND_TIER_DEFAULT).alias("spend_tier"),
        tier("distinct_drugs", POLYPHARMACY_TIERS, POLYPHARMACY_DEFAULT).alias(
            "polypharmacy_flag"
        ),
        *SPEND_POINTS,
        "first_name",
        "last_name",
        "gender",
        "birth_date",
        age_year_diff("birth_date", as_of).alias("age"),
        F.col("plan_id").alias("lob"),
        days_since("last_fill_date", as_of).alias("days_since_last_fill"),
    )
    return found.orderBy(F.desc("total_drug_spend"), "member_id") if ordered else found


def drug_type_mix(lines: DataFrame, members: DataFrame, as_of: Day) -> DataFrame:
    """Drug-type mix by age band, gender and line of business, over ``member_lines``.

    Lines are reduced to one row per member and drug type before the members join, so at
    most three rows per member reach it.
    """
    drug_type = band("amount", DRUG_TYPE_CUTS, DRUG_TYPE_LABELS)
    typed_lines = lines.withColumn("drug_type", drug_type)
    per_member = summarise(
        typed_lines,
        ["member_id", "drug_type"],
        {"lines": _rows(), "priced": F.count("amount"), "cents": F.sum(cents("amount"))},
    )
    people = members.select(
        "member_id",
        band(age_year_diff("birth_date", as_of), AGE_CUTS, AGE_LABELS).alias("age_band"),
        "gender",
        F.col("plan_id").alias("lob"),
    )
    cell = ["age_band", "gender", "lob"]
    mix = summarise(
        per_member.join(people, "member_id"),
        [*cell, "drug_type"],
        {
            "line_count": F.sum("lines"),
            "member_count": F.count_distinct("member_id"),
            "total_drug_spend": dollars(F.sum("cents")),
            "avg_drug_cost": ratio(F.sum("cents"), F.sum("priced") * 100),
        },
    )
    shared = share_pct(mix, cents("total_drug_spend"), cell, "pct_of_cell_spend")
    credibility = tier("line_count", CREDIBILITY_TIERS, CREDIBILITY_DEFAULT)
    return shared.withColumn("credibility_indicator", credibility).orderBy(*cell, "drug_type")


# --- per member per month --------------------------------------------------------------------


def member_months(
    members: DataFrame, start: Day, end: Day, by: Sequence[str] = ("plan_id",)
) -> DataFrame:
    """Members active in each month, by key.

    No end of membership is known, so a member counts from the effective month to
    ``end``: an upper bound. Members are counted per effective month first; only those
    few counts are spread over the months, never the members.
    """
    first, last = F.trunc(as_date(start), "MM"), F.trunc(as_date(end), "MM")
    joined = summarise(
        members, ["member_id", *by], {"joined": F.min(first_of_month("effective_date"))}
    ).where(F.col("joined") <= last)
    arrivals = summarise(joined, ["joined", *by], {"arrived": _rows()})
    months = F.explode(F.sequence(F.greatest("joined", first), last, F.expr("interval 1 month")))
    spread = arrivals.select(months.alias("member_month"), *by, "arrived")
    return summarise(spread, ["member_month", *by], {"member_months": F.sum("arrived")})


def pmpm(claims: DataFrame, members: DataFrame, start: Day, end: Day) -> DataFrame:
    """Spend and claims per member month, by month and line of business.

    Months with members but without claims show zero. Claims outside the range of months
    do not count; their dates (and the month partition, where claims have one) are filtered
    in the scan. A member with several versions counts once, by the latest; members without
    a line of business are a line of their own.
    """
    people = dedup_best(members, ["member_id"], [F.desc("effective_date"), F.asc("plan_id")])
    exposure = member_months(people, start, end).select(
        F.col("member_month").alias("claim_month"), F.col("plan_id").alias("lob"), "member_months"
    )
    first = F.trunc(as_date(start), "MM")
    last = F.last_day(as_date(end))
    dated = claims.where(F.col("claim_date").between(first, last))
    if "claim_month" in claims.columns:
        dated = dated.where(F.col("claim_month").between(first, last))
    # One row per member and month meets the members.
    per_member = month_totals(dated, ["member_id"])
    lobs = people.select("member_id", F.col("plan_id").alias("lob"))
    spend = summarise(
        per_member.join(lobs, "member_id"),
        ["claim_month", "lob"],
        {"claim_count": F.sum("claim_count"), "cents": F.sum("cents")},
    ).select(
        F.col("claim_month").alias("__month"), F.col("lob").alias("__lob"), "claim_count", "cents"
    )
    same = (F.col("claim_month") == F.col("__month")) & F.col("lob").eqNullSafe(F.col("__lob"))
    rates = exposure.join(spend, same, "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in ("claim_count", "cents")}
    )
    return rates.select(
        "claim_month",
        "lob",
        "member_months",
        "claim_count",
        dollars("cents").alias("total_drug_spend"),
        ratio("cents", F.col("member_months") * 100).alias("pmpm"),
        ratio("claim_count", "member_months", 4).alias("claims_per_member_month"),
    ).orderBy("claim_month", "lob")


# --- before and after --------------------------------------------------------------------------


def event_months(
    df: DataFrame,
    by: Sequence[str],
    event_date: Day,
    date: str = "claim_date",
    amount: str = "total_charge",
) -> DataFrame:
    """Totals per month, key and side of the event; ``after`` holds from its day on."""
    dated = df.where(F.col(date).isNotNull())
    return monthly(
        dated.withColumn("after", F.col(date) >= as_date(event_date)),
        date,
        [*by, "after"],
        {"claim_count": _rows(), "cents": F.sum(cents(amount))},
    )


def compare_sides(months: DataFrame, by: Sequence[str]) -> DataFrame:
    """``event_months`` laid out per key: totals and monthly rates before and after.

    A side's months are those in which the key has rows on that side; the event's own
    month counts on both sides when the event falls inside it.
    """

    def side(after: bool, measure: Column) -> Column:
        of_side = F.when(F.col("after") == after, measure)
        return F.coalesce(F.sum(of_side), F.lit(0).cast("bigint"))

    measures = {
        "months": F.lit(1).cast("bigint"),
        "claims": F.col("claim_count"),
        "cents": F.col("cents"),
    }
    totals = {
        f"{tag}_{name}": side(after, measure)
        for tag, after in (("pre", False), ("post", True))
        for name, measure in measures.items()
    }
    rates = summarise(months, by, totals).withColumns(
        {
            f"{tag}_spend_per_month": ratio(f"{tag}_cents", F.col(f"{tag}_months") * 100)
            for tag in ("pre", "post")
        }
    )
    saved = F.col("pre_spend_per_month") - F.col("post_spend_per_month")
    return rates.select(
        *by,
        "pre_months",
        "post_months",
        "pre_claims",
        "post_claims",
        dollars("pre_cents").alias("pre_spend"),
        dollars("post_cents").alias("post_spend"),
        "pre_spend_per_month",
        "post_spend_per_month",
        growth("post_spend_per_month", "pre_spend_per_month").alias("change_pct"),
        F.round(saved, 2).alias("savings_per_month"),
    ).orderBy(*by)


def pre_post(
    df: DataFrame,
    by: Sequence[str],
    event_date: Day,
    date: str = "claim_date",
    amount: str = "total_charge",
) -> DataFrame:
    """Volume and spend before and from the event, per key of ``df``."""
    return compare_sides(event_months(df, by, event_date, date, amount), by)


def _channel_event_months(
    claims: DataFrame, providers: DataFrame, event_date: Day
) -> DataFrame:
    """``event_months`` by channel, from totals per pharmacy."""
    places = providers.select("provider_id", F.col("specialty").alias("channel"))
    months = event_months(claims, ["provider_id"], event_date)
    return resummarise(
        months.join(places, "provider_id", "left"),
        ["claim_month", "channel", "after"],
        ["claim_count", "cents"],
    )


def pre_post_by_channel(claims: DataFrame, providers: DataFrame, event_date: Day) -> DataFrame:
    """``pre_post`` per channel."""
    return compare_sides(_channel_event_months(claims, providers, event_date), ["channel"])


def impact(months: DataFrame, treated: Column) -> DataFrame:
    """Change of the treated keys less the change of all others; one row.

    ``months`` comes from ``event_months``, by the columns that ``treated`` needs; a key
    for which ``treated`` is NULL is compared against. Rates are spend per month.
    """
    flagged = months.withColumn("treated", F.coalesce(treated, F.lit(False)))
    groups = resummarise(flagged, ["claim_month", "treated", "after"], ["claim_count", "cents"])
    sides = compare_sides(groups, ["treated"])

    def of(flag: bool, name: str) -> Column:
        return F.max(F.when(F.col("treated") == flag, F.col(name)))

    rates = sides.agg(
        of(True, "pre_spend_per_month").alias("treated_pre"),
        of(True, "post_spend_per_month").alias("treated_post"),
        of(False, "pre_spend_per_month").alias("comparison_pre"),
        of(False, "post_spend_per_month").alias("comparison_post"),
    )
    treated_change = F.col("treated_post") - F.col("treated_pre")
    comparison_change = F.col("comparison_post") - F.col("comparison_pre")
    return rates.select(
        "*",
        F.round(treated_change, 2).alias("treated_change"),
        F.round(comparison_change, 2).alias("comparison_change"),
        F.round(treated_change - comparison_change, 2).alias("impact"),
    )


def channel_impact(
    claims: DataFrame, providers: DataFrame, channel: str, event_date: Day
) -> DataFrame:
    """``impact`` of an event on one channel, all others as the comparison."""
    months = _channel_event_months(claims, providers, event_date)
    return impact(months, F.col("channel") == channel)
