"""The gold reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.checks.registry import half_up, query, quotient, sum_cents, whole_cents
from rxlens.operators.aggregates import percentiles, to_wide
from rxlens.operators.joins import with_lob
from rxlens.operators.rows import top_k
from rxlens.operators.trend import share_shift
from rxlens.plans import gold
from rxlens.sources.star import AS_OF, StarTables

LOBS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
MONTHS = ("1995-01-01", "2001-08-01")
EVENT = "1998-04-15"

CHARGE = sum_cents("total_charge")
MONTH = "CAST(date_trunc('month', claim_date) AS DATE)"


def member_lines(t: StarTables) -> DataFrame:
    return gold.member_lines(t.claims(with_provider=False), t.procedures(with_desc=False))


# --- spend by pharmacy and channel -----------------------------------------------------

CHANNEL_SUMMARY = f"""
    channel_summary AS (
      SELECT p.specialty AS channel, p.state, count(*) AS claim_count,
             {CHARGE} / 100.0 AS total_drug_spend,
             {quotient(CHARGE, 'count(*) * 100')} AS avg_spend_per_claim
      FROM claims c LEFT JOIN providers p ON p.provider_id = c.provider_id
      GROUP BY p.specialty, p.state)
"""


@query(
    "spend_by_provider",
    f"""
    SELECT p.provider_id AS pharmacy_id, p.provider_name AS pharmacy_name,
           p.specialty AS channel, count(*) AS claim_count,
           {CHARGE} / 100.0 AS total_drug_spend
    FROM claims c LEFT JOIN providers p ON p.provider_id = c.provider_id
    GROUP BY ALL
    """,
)
def spend_by_provider(t: StarTables) -> DataFrame:
    return gold.spend_by_provider(t.claims(), t.providers())


@query(
    "top_pharmacies",
    f"""
    SELECT p.provider_id AS pharmacy_id, p.provider_name AS pharmacy_name,
           p.specialty AS channel, count(*) AS claim_count,
           {CHARGE} / 100.0 AS total_drug_spend
    FROM claims c JOIN providers p ON p.provider_id = c.provider_id
    GROUP BY ALL ORDER BY total_drug_spend DESC, pharmacy_id LIMIT 10
    """,
)
def top_pharmacies(t: StarTables) -> DataFrame:
    spend = gold.spend_by_provider(t.claims(), t.providers())
    known = spend.where(F.col("pharmacy_id").isNotNull())
    return top_k(known, 10, [F.desc("total_drug_spend")], ["pharmacy_id"])


@query("channel_summary", f"{CHANNEL_SUMMARY} SELECT * FROM channel_summary")
def channel_summary(t: StarTables) -> DataFrame:
    return gold.channel_summary(t.claims(), t.providers())


@query(
    "channel_summary_ranked",
    f"""{CHANNEL_SUMMARY}
    SELECT channel, state, CAST(sum(claim_count) AS BIGINT) AS claim_count,
           sum(total_drug_spend) AS total_drug_spend,
           avg(avg_spend_per_claim) AS avg_spend_per_claim
    FROM channel_summary GROUP BY channel, state
    """,
)
def channel_summary_ranked(t: StarTables) -> DataFrame:
    return gold.channel_summary_ranked(gold.channel_summary(t.claims(), t.providers()))


# --- trends ----------------------------------------------------------------------------


def month_totals(source: str, by: str = "", amount: str = "total_charge") -> str:
    key = f"{by}, " if by else ""
    return f"""
      SELECT {MONTH} AS claim_month, {key}count(*) AS claim_count,
             {sum_cents(amount)} AS cents
      FROM {source} GROUP BY ALL"""


def trend_sql(by: str = "", calendar: bool = False) -> str:
    """Oracle text of the trend over a CTE called months."""
    part = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    if calendar:
        same = f"AND q.{by} IS NOT DISTINCT FROM p.{by}" if by else ""

        def prior(n: int) -> str:
            return f"""(SELECT max(q.spend) FROM priced q
                        WHERE q.claim_month = CAST(p.claim_month - INTERVAL {n} MONTH AS DATE)
                        {same})"""
    else:

        def prior(n: int) -> str:
            return f"lag(spend, {n}) OVER ({part} ORDER BY claim_month)"

    window = f"({part} ORDER BY claim_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    moving = f"CAST(sum(cents) OVER {window} AS DOUBLE) / (count(cents) OVER {window} * 100)"
    return f"""
    priced AS (SELECT *, cents / 100.0 AS spend FROM months),
    lagged AS (
      SELECT p.*, {prior(1)} AS m1, {prior(12)} AS m12,
             {half_up(moving)} AS moving_avg_3mo
      FROM priced p)
    SELECT claim_month, {key}claim_count, spend AS total_drug_spend,
           {quotient('cents', 'claim_count * 100')} AS avg_spend_per_claim,
           m1 AS prior_month_spend,
           {half_up('(spend - m1) / nullif(m1, 0) * 100')} AS mom_growth_pct,
           m12 AS prior_year_spend,
           {half_up('(spend - m12) / nullif(m12, 0) * 100')} AS yoy_growth_pct,
           moving_avg_3mo
    FROM lagged"""


BY_LOB = "(SELECT c.*, m.plan_id AS lob FROM claims c JOIN members m USING (member_id)) x"
BY_CHANNEL = """(SELECT c.*, p.specialty AS channel FROM claims c
                 LEFT JOIN providers p USING (provider_id)) x"""
BY_DRUG = """(SELECT c.claim_date, p.procedure_code, p.amount FROM claims c
              JOIN procedures p USING (claim_id)) x"""


@query("spend_trend", f"months AS ({month_totals('claims')}), {trend_sql()}")
def spend_trend(t: StarTables) -> DataFrame:
    return gold.spend_trend(t.claims(with_provider=False))


@query(
    "spend_trend_calendar", f"months AS ({month_totals('claims')}), {trend_sql(calendar=True)}"
)
def spend_trend_calendar(t: StarTables) -> DataFrame:
    return gold.spend_trend(t.claims(with_provider=False), calendar=True)


@query("spend_trend_by_lob", f"months AS ({month_totals(BY_LOB, 'lob')}), {trend_sql('lob')}")
def spend_trend_by_lob(t: StarTables) -> DataFrame:
    return gold.spend_trend(with_lob(t.claims(with_provider=False), t.members()), ["lob"])


@query(
    "spend_trend_by_channel",
    f"months AS ({month_totals(BY_CHANNEL, 'channel')}), {trend_sql('channel')}",
)
def spend_trend_by_channel(t: StarTables) -> DataFrame:
    return gold.spend_trend_by_channel(t.claims(), t.providers())


@query(
    "spend_trend_by_drug",
    f"""months AS ({month_totals(BY_DRUG, 'procedure_code', 'amount')}),
        {trend_sql('procedure_code')}""",
)
def spend_trend_by_drug(t: StarTables) -> DataFrame:
    return gold.spend_trend_by_drug(member_lines(t))


# --- decisions -------------------------------------------------------------------------

DECISIONS = f"""
    decisions AS (
      SELECT {MONTH} AS claim_month, m.plan_id AS lob, upper(c.claim_status) AS decision_status,
             c.total_charge, date_diff('day', m.effective_date, c.claim_date) AS turnaround
      FROM claims c JOIN members m ON m.member_id = c.member_id)
"""
TURNAROUND = quotient("sum(turnaround)", "count(turnaround)", 1)
VOLUME = f"""{DECISIONS},
    counted AS (
      SELECT claim_month, decision_status, count(*) AS claim_count,
             {CHARGE} / 100.0 AS total_drug_spend, {TURNAROUND} AS avg_turnaround_days_proxy
      FROM decisions GROUP BY claim_month, decision_status),
    volume AS (
      SELECT *, {quotient('claim_count * 100',
                          'sum(claim_count) OVER (PARTITION BY claim_month)')} AS pct_of_month
      FROM counted)
"""


@query("decision_volume", f"{VOLUME} SELECT * FROM volume")
def decision_volume(t: StarTables) -> DataFrame:
    return gold.decision_volume(t.claims(with_provider=False), t.members())


@query(
    "approval_rate",
    f"""{VOLUME},
    rolled AS (
      SELECT claim_month,
             CAST(sum(claim_count) FILTER (decision_status = 'APPROVED') AS BIGINT) AS a,
             CAST(sum(claim_count) FILTER (decision_status = 'DENIED') AS BIGINT) AS d,
             CAST(sum(claim_count) FILTER (decision_status = 'PENDING') AS BIGINT) AS p,
             CAST(sum(claim_count) AS BIGINT) AS total_claims
      FROM volume GROUP BY claim_month)
    SELECT claim_month, coalesce(a, 0) AS approved, coalesce(d, 0) AS denied,
           coalesce(p, 0) AS pending, total_claims,
           {quotient('coalesce(a, 0) * 100', 'total_claims')} AS approval_rate_pct
    FROM rolled
    """,
)
def approval_rate(t: StarTables) -> DataFrame:
    return gold.approval_rate(gold.decision_volume(t.claims(with_provider=False), t.members()))


@query(
    "approval_by_lob",
    f"""{DECISIONS}
    SELECT claim_month, lob, count(*) AS total_claims,
           count(*) FILTER (decision_status = 'APPROVED') AS approved,
           count(*) FILTER (decision_status = 'DENIED') AS denied,
           {quotient("count(*) FILTER (decision_status = 'APPROVED') * 100", 'count(*)')}
             AS approval_rate_pct,
           {TURNAROUND} AS avg_turnaround_days_proxy
    FROM decisions GROUP BY claim_month, lob
    """,
)
def approval_by_lob(t: StarTables) -> DataFrame:
    return gold.approval_by_lob(t.claims(with_provider=False), t.members())


@query(
    "share_shift",
    f"""{VOLUME},
    shifted AS (
      SELECT *, lag(pct_of_month) OVER (PARTITION BY decision_status ORDER BY claim_month) AS before
      FROM volume)
    SELECT claim_month, decision_status, claim_count, total_drug_spend,
           avg_turnaround_days_proxy, pct_of_month,
           {half_up('pct_of_month - before')} AS pct_shift
    FROM shifted
    """,
)
def status_shift(t: StarTables) -> DataFrame:
    volume = gold.decision_volume(t.claims(with_provider=False), t.members())
    return share_shift(
        volume, "claim_month", "decision_status", "claim_count", "pct_of_month", "pct_shift"
    )


# --- members and drugs -----------------------------------------------------------------

MEMBER_SUMMARY = f"""
    member_summary AS (
      SELECT member_id, count(claim_id) AS claim_count, {CHARGE} / 100.0 AS total_drug_spend,
             {quotient(CHARGE, 'count(total_charge) * 100')} AS avg_spend_per_claim,
             min(claim_date) AS first_fill_date, max(claim_date) AS last_fill_date,
             count(DISTINCT year(claim_date)) AS years_with_fills
      FROM claims GROUP BY member_id),
    thresholds AS (
      SELECT {half_up('quantile_cont(total_drug_spend, 0.95)', 4)} AS p95_threshold,
             {half_up('quantile_cont(total_drug_spend, 0.90)', 4)} AS p90_threshold,
             {half_up('quantile_cont(total_drug_spend, 0.75)', 4)} AS p75_threshold
      FROM member_summary)
"""
HIGH_COST = f"""{MEMBER_SUMMARY},
    drugs AS (
      SELECT c.member_id, count(DISTINCT p.procedure_code) AS n
      FROM claims c JOIN procedures p ON p.claim_id = c.claim_id GROUP BY c.member_id),
    high_cost AS (
      SELECT s.member_id, s.claim_count, s.total_drug_spend, s.avg_spend_per_claim,
             s.first_fill_date, s.last_fill_date, s.years_with_fills,
             coalesce(d.n, 0) AS distinct_drugs,
             CASE WHEN s.total_drug_spend >= p95_threshold THEN 'Tier 1 — Critical (95th+ pct)'
                  WHEN s.total_drug_spend >= p90_threshold THEN 'Tier 2 — High (90th-95th pct)'
                  ELSE 'Tier 3 — Moderate (75th-90th pct)' END AS spend_tier,
             CASE WHEN coalesce(d.n, 0) >= 10 THEN 'Polypharmacy — Refer to clinical review'
                  WHEN coalesce(d.n, 0) >= 5 THEN 'Watch list'
                  ELSE 'Standard' END AS polypharmacy_flag,
             p95_threshold, p90_threshold, p75_threshold,
             m.first_name, m.last_name, m.gender, m.birth_date,
             CAST(2001 - year(m.birth_date) AS INTEGER) AS age, m.plan_id AS lob,
             CAST(DATE '{AS_OF}' - s.last_fill_date AS INTEGER) AS days_since_last_fill
      FROM member_summary s
      JOIN members m ON m.member_id = s.member_id
      LEFT JOIN drugs d ON d.member_id = s.member_id, thresholds
      WHERE s.total_drug_spend >= p75_threshold)
"""


@query("member_percentiles", f"{MEMBER_SUMMARY} SELECT * FROM thresholds")
def member_percentiles(t: StarTables) -> DataFrame:
    return gold.member_percentiles(gold.member_summary(t.claims(with_provider=False)))


POINTS = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
POINT_SQL = ", ".join(
    f"{half_up(f'quantile_cont(total_charge, {p})', 4)} AS {name}" for name, p in POINTS.items()
)


@query("claim_percentiles", f"SELECT {POINT_SQL} FROM claims")
def claim_percentiles(t: StarTables) -> DataFrame:
    found = percentiles(t.claims(with_provider=False), "total_charge", POINTS)
    return found.select(*[F.round(name, 4).alias(name) for name in POINTS])


@query("member_summary", f"{MEMBER_SUMMARY} SELECT * FROM member_summary")
def member_summary(t: StarTables) -> DataFrame:
    return gold.member_summary(t.claims(with_provider=False))


def _high_cost(t: StarTables, ordered: bool) -> DataFrame:
    claims = t.claims(with_provider=False)
    return gold.high_cost_members(claims, member_lines(t), t.members(), AS_OF, ordered=ordered)


@query("high_cost_members", f"{HIGH_COST} SELECT * FROM high_cost")
def high_cost_members(t: StarTables) -> DataFrame:
    return _high_cost(t, ordered=True)


@query(
    "top_members",
    f"""{HIGH_COST}
    SELECT * FROM high_cost ORDER BY total_drug_spend DESC, member_id LIMIT 20
    """,
)
def top_members(t: StarTables) -> DataFrame:
    return top_k(_high_cost(t, ordered=False), 20, [F.desc("total_drug_spend")], ["member_id"])


@query(
    "drug_type_mix",
    f"""
    lines AS (
      SELECT c.member_id, m.gender, m.plan_id AS lob, p.amount,
             CASE WHEN 2001 - year(m.birth_date) < 18 THEN '0-17'
                  WHEN 2001 - year(m.birth_date) < 35 THEN '18-34'
                  WHEN 2001 - year(m.birth_date) < 50 THEN '35-49'
                  WHEN 2001 - year(m.birth_date) < 65 THEN '50-64' ELSE '65+' END AS age_band,
             CASE WHEN p.amount < 100 THEN 'Generic (proxy)'
                  WHEN p.amount < 1000 THEN 'Brand (proxy)'
                  ELSE 'Specialty (proxy)' END AS drug_type
      FROM claims c JOIN procedures p ON p.claim_id = c.claim_id
                    JOIN members m ON m.member_id = c.member_id),
    mix AS (
      SELECT age_band, gender, lob, drug_type, count(*) AS line_count,
             count(DISTINCT member_id) AS member_count, {sum_cents('amount')} AS cents,
             count(amount) AS priced
      FROM lines GROUP BY ALL)
    SELECT age_band, gender, lob, drug_type, line_count, member_count,
           cents / 100.0 AS total_drug_spend, {quotient('cents', 'priced * 100')} AS avg_drug_cost,
           {quotient('CAST(cents AS DOUBLE) * 100',
                     'sum(cents) OVER (PARTITION BY age_band, gender, lob)')} AS pct_of_cell_spend,
           CASE WHEN line_count >= 1000 THEN 'Full credibility'
                WHEN line_count >= 500 THEN 'Partial credibility'
                WHEN line_count >= 100 THEN 'Limited credibility'
                ELSE 'Low credibility' END AS credibility_indicator
    FROM mix
    """,
)
def drug_type_mix(t: StarTables) -> DataFrame:
    return gold.drug_type_mix(member_lines(t), t.members(), AS_OF)


# --- per member per month --------------------------------------------------------------

MEMBER_MONTHS = f"""
    months AS (
      SELECT CAST(unnest(generate_series(DATE '{MONTHS[0]}', DATE '{MONTHS[1]}',
                                         INTERVAL 1 MONTH)) AS DATE) AS member_month),
    member_months AS (
      SELECT member_month, plan_id, count(DISTINCT member_id) AS member_months
      FROM months JOIN members ON date_trunc('month', effective_date) <= member_month
      GROUP BY member_month, plan_id)
"""
PMPM = f"""{MEMBER_MONTHS},
    spend AS (
      SELECT {MONTH} AS claim_month, m.plan_id AS lob, count(*) AS n, {CHARGE} AS cents
      FROM claims c JOIN members m ON m.member_id = c.member_id GROUP BY ALL),
    pmpm AS (
      SELECT member_month AS claim_month, plan_id AS lob, member_months,
             coalesce(n, 0) AS claim_count, coalesce(cents, 0) / 100.0 AS total_drug_spend,
             {quotient('coalesce(cents, 0)', 'member_months * 100')} AS pmpm,
             {quotient('coalesce(n, 0)', 'member_months', 4)} AS claims_per_member_month
      FROM member_months LEFT JOIN spend ON claim_month = member_month AND lob = plan_id)
"""


@query("member_months", f"{MEMBER_MONTHS} SELECT * FROM member_months")
def member_months(t: StarTables) -> DataFrame:
    return gold.member_months(t.members(), *MONTHS)


@query(
    "membership_trend",
    f"""{MEMBER_MONTHS},
    lagged AS (
      SELECT *, lag(member_months, 1) OVER w AS prior_month_members,
             lag(member_months, 12) OVER w AS prior_year_members
      FROM member_months WINDOW w AS (PARTITION BY plan_id ORDER BY member_month))
    SELECT *,
           {half_up('(member_months - prior_month_members) / prior_month_members::DOUBLE * 100')}
             AS mom_growth_pct,
           {half_up('(member_months - prior_year_members) / prior_year_members::DOUBLE * 100')}
             AS yoy_growth_pct
    FROM lagged
    """,
)
def membership_trend(t: StarTables) -> DataFrame:
    return gold.membership_trend(t.members(), *MONTHS)


@query("pmpm", f"{PMPM} SELECT * FROM pmpm")
def pmpm(t: StarTables) -> DataFrame:
    return gold.pmpm(t.claims(with_provider=False), t.members(), *MONTHS)


@query(
    "pmpm_wide",
    f"""{PMPM}
    SELECT claim_month, {', '.join(f"sum(pmpm) FILTER (lob = '{x}') AS {x}" for x in LOBS)}
    FROM pmpm GROUP BY claim_month
    """,
)
def pmpm_wide(t: StarTables) -> DataFrame:
    rates = gold.pmpm(t.claims(with_provider=False), t.members(), *MONTHS)
    return to_wide(rates, ["claim_month"], "lob", LOBS, "pmpm")


# --- before and after ------------------------------------------------------------------


def pre_post_sql(source: str, by: str) -> str:
    after = f"claim_date >= DATE '{EVENT}'"
    sides = "".join(
        f"""count(DISTINCT {MONTH}) FILTER ({cond}) AS {tag}_months,
            count(*) FILTER ({cond}) AS {tag}_claims,
            coalesce(CAST(sum({whole_cents('total_charge')}) FILTER ({cond}) AS BIGINT), 0)
              AS {tag}_cents,"""
        for tag, cond in (("pre", f"NOT {after}"), ("post", after))
    )
    return f"""
    sides AS (SELECT {sides} {by} FROM {source} GROUP BY {by}),
    rates AS (
      SELECT *, {quotient('pre_cents', 'pre_months * 100')} AS pre_spend_per_month,
             {quotient('post_cents', 'post_months * 100')} AS post_spend_per_month
      FROM sides)"""


@query(
    "pre_post",
    f"""{pre_post_sql(BY_CHANNEL, 'channel')}
    SELECT channel, pre_months, post_months, pre_claims, post_claims,
           pre_cents / 100.0 AS pre_spend, post_cents / 100.0 AS post_spend,
           pre_spend_per_month, post_spend_per_month,
           {half_up('''(post_spend_per_month - pre_spend_per_month)
                       / nullif(pre_spend_per_month, 0) * 100''')} AS change_pct,
           {half_up('pre_spend_per_month - post_spend_per_month')} AS savings_per_month
    FROM rates
    """,
)
def pre_post(t: StarTables) -> DataFrame:
    return gold.pre_post_by_channel(t.claims(), t.providers(), EVENT)


@query(
    "pre_post_by_status",
    f"""{pre_post_sql('claims', 'claim_status')}
    SELECT claim_status, pre_months, post_months, pre_claims, post_claims,
           pre_cents / 100.0 AS pre_spend, post_cents / 100.0 AS post_spend,
           pre_spend_per_month, post_spend_per_month,
           {half_up('''(post_spend_per_month - pre_spend_per_month)
                       / nullif(pre_spend_per_month, 0) * 100''')} AS change_pct,
           {half_up('pre_spend_per_month - post_spend_per_month')} AS savings_per_month
    FROM rates
    """,
)
def pre_post_by_status(t: StarTables) -> DataFrame:
    return gold.pre_post(t.claims(with_provider=False), ["claim_status"], EVENT)


@query(
    "impact",
    f"""{pre_post_sql(
        "(SELECT *, coalesce(channel = 'Mail Order', false) AS treated FROM " + BY_CHANNEL + ")",
        "treated")},
    flat AS (
      SELECT max(pre_spend_per_month) FILTER (treated) AS treated_pre,
             max(post_spend_per_month) FILTER (treated) AS treated_post,
             max(pre_spend_per_month) FILTER (NOT treated) AS comparison_pre,
             max(post_spend_per_month) FILTER (NOT treated) AS comparison_post
      FROM rates)
    SELECT *, {half_up('treated_post - treated_pre')} AS treated_change,
           {half_up('comparison_post - comparison_pre')} AS comparison_change,
           {half_up('(treated_post - treated_pre) - (comparison_post - comparison_pre)')} AS impact
    FROM flat
    """,
)
def impact(t: StarTables) -> DataFrame:
    return gold.channel_impact(t.claims(), t.providers(), "Mail Order", EVENT)
