"""The general operators, each run over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.checks.gold_queries import BY_CHANNEL, MONTH, month_totals
from rxlens.checks.registry import half_up, query, quotient, sum_cents
from rxlens.functions import (
    age_exact,
    age_year_diff,
    as_date,
    average_money,
    band,
    clean_amount,
    days_since,
    first_of_month,
    map_code,
    month_boundaries,
    norm_code,
    total_money,
)
from rxlens.operators import joins, quality, tables
from rxlens.operators.aggregates import count_when, freq, monthly, summarise, to_wide
from rxlens.operators.reuse import cached, checkpoint_stage, stage_if_shared
from rxlens.operators.rows import append_all, dedup_best
from rxlens.operators.trend import (
    flag_anomalies,
    growth_pct,
    moving_avg,
    running_total,
    share_pct,
    with_lag,
    with_lead,
)
from rxlens.plans import gold
from rxlens.sources import layers
from rxlens.sources.star import AS_OF, StarTables, channel_code
from rxlens.values import CHANNEL_CODES, RISK_CUTS, RISK_LABELS, UNKNOWN_LABEL

PLAN = "MACHINERY"
CUTOFF = "2001-01-01"


def claims_of(t: StarTables) -> DataFrame:
    return t.claims(with_provider=False)


# --- projection, filter, types -----------------------------------------------------------


@query(
    "select_filter",
    """
    SELECT claim_id AS id, claim_status, total_charge, total_charge * 1.5 AS loaded_charge
    FROM claims WHERE total_charge > 250000 AND provider_id IS NOT NULL
    """,
)
def select_filter(t: StarTables) -> DataFrame:
    """Select, filter, add, rename and drop columns."""
    return (
        t.claims()
        .filter((F.col("total_charge") > 250000) & F.col("provider_id").isNotNull())
        .withColumn("loaded_charge", F.col("total_charge") * 1.5)
        .withColumnRenamed("claim_id", "id")
        .drop("member_id", "provider_id", "claim_date")
    )


@query(
    "risk_category",
    """
    SELECT claim_id, procedure_code, amount,
           CASE WHEN amount < 1000 THEN 'Low' WHEN amount < 5000 THEN 'Medium'
                ELSE 'High' END AS risk_category
    FROM procedures
    """,
)
def risk_category(t: StarTables) -> DataFrame:
    lines = t.procedures(with_desc=False)
    return lines.withColumn("risk_category", band("amount", RISK_CUTS, RISK_LABELS))


@query(
    "map_code",
    """
    SELECT provider_id, CASE WHEN provider_id % 3 = 0 THEN 'R' WHEN provider_id % 3 = 1 THEN 'M'
                             ELSE 'S' END AS channel_code,
           specialty AS channel,
           CASE provider_id % 3 WHEN 0 THEN 'Retail' ELSE 'Unknown' END AS only_retail
    FROM providers
    """,
)
def code_labels(t: StarTables) -> DataFrame:
    coded = t.providers().select(
        "provider_id", channel_code(F.col("provider_id")).alias("channel_code")
    )
    retail = {"R": CHANNEL_CODES["R"]}
    return coded.withColumns(
        {
            "channel": map_code("channel_code", CHANNEL_CODES, UNKNOWN_LABEL),
            "only_retail": map_code("channel_code", retail, UNKNOWN_LABEL),
        }
    )


@query(
    "scalar_strings",
    """
    SELECT provider_id, upper(trim(' ' || provider_name || ' ')) AS norm_name,
           lower(state) AS state_lower, concat(city, ', ', state) AS place,
           substring(npi, 8, 3) AS npi_tail,
           regexp_replace(provider_name, '[^0-9]', '', 'g') AS digits
    FROM providers
    """,
)
def scalar_strings(t: StarTables) -> DataFrame:
    padded = F.concat(F.lit(" "), "provider_name", F.lit(" "))
    return t.providers().select(
        "provider_id",
        norm_code(padded).alias("norm_name"),
        F.lower("state").alias("state_lower"),
        F.concat("city", F.lit(", "), "state").alias("place"),
        F.substring("npi", 8, 3).alias("npi_tail"),
        F.regexp_replace("provider_name", "[^0-9]", "").alias("digits"),
    )


@query(
    "clean_amounts",
    f"""
    SELECT claim_id, procedure_code, {half_up('amount')} AS as_charge,
           {half_up('-amount')} AS as_refund
    FROM procedures
    """,
)
def clean_amounts(t: StarTables) -> DataFrame:
    """Money text of a refund, read without and with its sign."""
    text = F.concat(F.lit("-$"), F.format_number("amount", 2))
    lines = t.procedures(with_desc=False).withColumn("text", text)
    return lines.select(
        "claim_id",
        "procedure_code",
        clean_amount("text").alias("as_charge"),
        clean_amount("text", keep_sign=True).alias("as_refund"),
    )


@query(
    "scalar_math",
    f"""
    SELECT claim_id, abs(total_charge - 250000) AS gap, CAST(ceil(total_charge) AS BIGINT) AS up,
           CAST(floor(total_charge) AS BIGINT) AS down, {half_up('total_charge / 7', 3)} AS seventh,
           {half_up('total_charge * 100 / nullif(claim_id, 0)')} AS per_id
    FROM claims
    """,
)
def scalar_math(t: StarTables) -> DataFrame:
    charge = F.col("total_charge")
    return claims_of(t).select(
        "claim_id",
        F.abs(charge - 250000).alias("gap"),
        F.ceil(charge).alias("up"),
        F.floor(charge).alias("down"),
        F.round(charge / 7, 3).alias("seventh"),
        F.round(F.try_divide(charge * 100, F.col("claim_id")), 2).alias("per_id"),
    )


@query(
    "scalar_dates",
    f"""
    SELECT claim_id, CAST(year(claim_date) AS INTEGER) AS yr,
           CAST(month(claim_date) AS INTEGER) AS mon, {MONTH} AS month_start,
           CAST(claim_date + 30 AS DATE) AS refill_due,
           CAST(claim_date - INTERVAL 1 MONTH AS DATE) AS month_before,
           CAST(claim_date + INTERVAL 12 MONTH AS DATE) AS year_after,
           make_date(CAST(year(claim_date) AS INTEGER), 12, 31) AS year_end,
           strftime(claim_date, '%Y-%m-%d') AS iso_text,
           CAST(DATE '{AS_OF}' - claim_date AS INTEGER) AS days_old,
           CAST((2001 * 12 + 12) - (year(claim_date) * 12 + month(claim_date)) AS INTEGER)
             AS months_crossed,
           {half_up(f'''CASE WHEN day(claim_date) = 31 OR claim_date = last_day(claim_date)
             THEN (2001 * 12 + 12) - (year(claim_date) * 12 + month(claim_date))
             ELSE (2001 * 12 + 12) - (year(claim_date) * 12 + month(claim_date))
                  + (31 - day(claim_date)) / 31.0 END''', 4)} AS months_elapsed,
           DATE '{AS_OF}' AS as_of
    FROM claims
    """,
)
def scalar_dates(t: StarTables) -> DataFrame:
    day = F.col("claim_date")
    return claims_of(t).select(
        "claim_id",
        F.year(day).alias("yr"),
        F.month(day).alias("mon"),
        first_of_month(day).alias("month_start"),
        F.date_add(day, 30).alias("refill_due"),
        F.add_months(day, -1).alias("month_before"),
        F.add_months(day, 12).alias("year_after"),
        F.make_date(F.year(day), F.lit(12), F.lit(31)).alias("year_end"),
        F.date_format(day, "yyyy-MM-dd").alias("iso_text"),
        days_since(day, AS_OF).alias("days_old"),
        month_boundaries(day, as_date(AS_OF)).alias("months_crossed"),
        F.round(F.months_between(as_date(AS_OF), day), 4).alias("months_elapsed"),
        as_date(AS_OF).alias("as_of"),
    )


@query(
    "member_ages",
    """
    SELECT member_id, CAST(2000 - year(birth_date) AS INTEGER) AS age_year_diff,
           CAST(2000 - year(birth_date)
                - CASE WHEN month(birth_date) * 100 + day(birth_date) > 630 THEN 1 ELSE 0 END
                AS INTEGER) AS age_exact,
           CAST(DATE '2000-06-30' - effective_date AS INTEGER) AS days_enrolled
    FROM members
    """,
)
def member_ages(t: StarTables) -> DataFrame:
    day = "2000-06-30"
    return t.members().select(
        "member_id",
        age_year_diff("birth_date", day).alias("age_year_diff"),
        age_exact("birth_date", day).alias("age_exact"),
        days_since("effective_date", day).alias("days_enrolled"),
    )


@query(
    "null_handling",
    """
    SELECT claim_id, provider_id IS NULL AS no_pharmacy, provider_id IS NOT NULL AS has_pharmacy,
           coalesce(provider_id, -1) AS pharmacy, nullif(claim_status, 'pending') AS decided
    FROM claims
    """,
)
def null_handling(t: StarTables) -> DataFrame:
    pharmacy = F.col("provider_id")
    return t.claims().select(
        "claim_id",
        pharmacy.isNull().alias("no_pharmacy"),
        pharmacy.isNotNull().alias("has_pharmacy"),
        F.coalesce(pharmacy, F.lit(-1)).alias("pharmacy"),
        F.nullif("claim_status", F.lit("pending")).alias("decided"),
    )


@query(
    "parameterised_sql",
    f"""
    SELECT claim_id, member_id, claim_date, total_charge FROM claims
    WHERE claim_date <= DATE '{CUTOFF}'
      AND member_id IN (SELECT member_id FROM members WHERE plan_id = '{PLAN}')
    """,
)
def parameterised_sql(t: StarTables) -> DataFrame:
    """SQL text over temporary views, with named parameters."""
    claims_of(t).createOrReplaceTempView("rx_claims")
    t.members().createOrReplaceTempView("rx_members")
    return t.spark.sql(
        """
        SELECT claim_id, member_id, claim_date, total_charge FROM rx_claims
        WHERE claim_date <= :until AND EXISTS (
          SELECT 1 FROM rx_members m WHERE m.member_id = rx_claims.member_id AND plan_id = :plan)
        """,
        args={"until": dt.date.fromisoformat(CUTOFF), "plan": PLAN},
    )


# --- joins -------------------------------------------------------------------------------


@query(
    "claims_enriched",
    """
    SELECT c.*, m.gender, m.birth_date, m.plan_id AS lob, m.effective_date,
           p.provider_name, p.specialty AS channel, p.state
    FROM claims c LEFT JOIN members m ON m.member_id = c.member_id
                  LEFT JOIN providers p ON p.provider_id = c.provider_id
    """,
)
def enriched(t: StarTables) -> DataFrame:
    return joins.claims_enriched(t.claims(), t.members(), t.providers())


@query(
    "lookup_join",
    """
    SELECT c.claim_id, c.provider_id, coalesce(p.specialty, 'Unknown') AS specialty
    FROM claims c LEFT JOIN providers p ON p.provider_id = c.provider_id
    """,
)
def lookup_join(t: StarTables) -> DataFrame:
    claims = t.claims().select("claim_id", "provider_id")
    return joins.lookup(claims, t.providers(), "provider_id", "specialty", UNKNOWN_LABEL)


@query(
    "join_default",
    """
    SELECT m.member_id, coalesce(n, 0) AS denied_claims
    FROM members m LEFT JOIN (SELECT member_id, count(*) AS n FROM claims
                              WHERE claim_status = 'denied' GROUP BY member_id) d
                   ON d.member_id = m.member_id
    """,
)
def denied_per_member(t: StarTables) -> DataFrame:
    denied = claims_of(t).where("claim_status = 'denied'")
    counts = summarise(denied, ["member_id"], {"denied_claims": F.count("claim_id")})
    return joins.join_default(
        t.members().select("member_id"), counts, "member_id", {"denied_claims": 0}
    )


@query(
    "semi_join_plan",
    f"""
    SELECT * FROM claims
    WHERE member_id IN (SELECT member_id FROM members WHERE plan_id = '{PLAN}')
    """,
)
def semi_join_plan(t: StarTables) -> DataFrame:
    return joins.members_in_plan(t.claims(), t.members(), PLAN)


@query(
    "drug_lines",
    """
    SELECT c.claim_id, c.member_id, p.procedure_code, p.procedure_desc, p.amount,
           m.gender, m.birth_date, m.plan_id AS lob
    FROM claims c JOIN procedures p ON p.claim_id = c.claim_id
                  JOIN members m ON m.member_id = c.member_id
    """,
)
def drug_lines(t: StarTables) -> DataFrame:
    return joins.drug_lines(claims_of(t), t.procedures(), t.members())


@query(
    "above_average_claims",
    f"""
    mean AS (SELECT {quotient(sum_cents('total_charge'), 'count(total_charge) * 100')} AS m
             FROM claims)
    SELECT claim_id, total_charge, m AS mean_charge FROM claims, mean WHERE total_charge > m
    """,
)
def above_average_claims(t: StarTables) -> DataFrame:
    claims = claims_of(t).select("claim_id", "total_charge")
    mean = claims.agg(average_money("total_charge").alias("mean_charge"))
    return joins.with_scalars(claims, mean).where("total_charge > mean_charge")


@query(
    "reconcile",
    f"""
    billed AS (SELECT {MONTH} AS claim_month, count(*) AS claims,
                      {sum_cents('total_charge')} AS cents FROM claims GROUP BY 1),
    decided AS (SELECT {MONTH} AS claim_month, count(*) AS claims,
                       {sum_cents('total_charge')} AS cents FROM claims
                WHERE claim_status <> 'pending' AND claim_date < DATE '{CUTOFF}' GROUP BY 1)
    SELECT coalesce(b.claim_month, d.claim_month) AS claim_month,
           b.claims AS claims_left, d.claims AS claims_right,
           coalesce(b.claims, 0) - coalesce(d.claims, 0) AS claims_diff,
           b.cents AS cents_left, d.cents AS cents_right,
           coalesce(b.cents, 0) - coalesce(d.cents, 0) AS cents_diff,
           b.claims IS NOT DISTINCT FROM d.claims AND b.cents IS NOT DISTINCT FROM d.cents
             AS matches
    FROM billed b FULL OUTER JOIN decided d ON d.claim_month = b.claim_month
    """,
)
def reconcile_months(t: StarTables) -> DataFrame:
    """All claims against the decided ones of the years before the cut-off."""
    claims = claims_of(t).withColumn("claim_month", first_of_month("claim_date"))
    decided = claims.where(
        (F.col("claim_status") != "pending") & (F.col("claim_date") < as_date(CUTOFF))
    )
    whole = F.floor(F.col("total_charge") * 100 + F.lit(0.5))
    measures = {"claims": F.count("claim_id"), "cents": F.sum(whole)}
    return joins.reconcile(claims, decided, ["claim_month"], measures)


# --- sets, de-duplication, table state ---------------------------------------------------


@query(
    "append_all",
    "SELECT claim_id, claim_date, claim_status, total_charge FROM claims",
)
def append_years(t: StarTables) -> DataFrame:
    """Two yearly tables stacked; the second has its columns in another order."""
    claims = claims_of(t).select("claim_id", "claim_date", "claim_status", "total_charge")
    early = claims.where(F.col("claim_date") < as_date(CUTOFF))
    late = claims.where(F.col("claim_date") >= as_date(CUTOFF))
    return append_all(early, late.select(*reversed(late.columns)))


@query(
    "dedup_best",
    """
    SELECT member_id, max(total_charge) AS total_charge FROM claims GROUP BY member_id
    """,
)
def dearest_claim(t: StarTables) -> DataFrame:
    best = dedup_best(claims_of(t), ["member_id"], [F.desc("total_charge"), F.asc("claim_id")])
    return best.select("member_id", "total_charge")


@query(
    "latest_claim",
    """
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY member_id
                                   ORDER BY claim_date DESC, claim_id DESC) AS rn FROM claims)
    SELECT member_id, claim_id, claim_date, claim_status FROM ranked WHERE rn = 1
    """,
)
def latest_claim(t: StarTables) -> DataFrame:
    best = dedup_best(claims_of(t), ["member_id"], [F.desc("claim_date"), F.desc("claim_id")])
    return best.select("member_id", "claim_id", "claim_date", "claim_status")


@query(
    "distinct_by_key",
    "SELECT DISTINCT claim_id, procedure_code FROM procedures",
)
def distinct_by_key(t: StarTables) -> DataFrame:
    """Any row per key; the key is all that is the same from run to run."""
    kept = t.procedures(with_desc=False).dropDuplicates(["claim_id", "procedure_code"])
    return kept.select("claim_id", "procedure_code")


# The two states of the claims table: before the cut-off all claims dated earlier; then
# denied claims are gone, pending ones approved, and later claims added.
STATES = f"""
    old_state AS (SELECT claim_id, member_id, claim_date, claim_status, total_charge
                  FROM claims WHERE claim_date < DATE '{CUTOFF}'),
    new_state AS (SELECT claim_id, member_id, claim_date,
                         CASE claim_status WHEN 'pending' THEN 'approved'
                              ELSE claim_status END AS claim_status, total_charge
                  FROM claims WHERE claim_status <> 'denied')
"""
BATCHES = (dt.date(2001, 1, 1), dt.date(2001, 9, 1))


def states(t: StarTables) -> tuple[DataFrame, DataFrame]:
    claims = claims_of(t).select(
        "claim_id", "member_id", "claim_date", "claim_status", "total_charge"
    )
    pending = F.col("claim_status") == "pending"
    new = tables.delete_where(claims, F.col("claim_status") == "denied")
    new = tables.update_where(new, pending, {"claim_status": F.lit("approved")})
    return claims.where(F.col("claim_date") < as_date(CUTOFF)), new


@query(
    "upsert",
    f"""{STATES}
    SELECT * FROM new_state
    UNION ALL SELECT * FROM old_state WHERE claim_id NOT IN (SELECT claim_id FROM new_state)
    """,
)
def upsert_claims(t: StarTables) -> DataFrame:
    old, new = states(t)
    return tables.upsert(old, new, ["claim_id"])


@query(
    "stored_upsert",
    f"""{STATES}
    SELECT * FROM new_state
    UNION ALL SELECT * FROM old_state WHERE claim_id NOT IN (SELECT claim_id FROM new_state)
    """,
)
def stored_upsert(t: StarTables) -> DataFrame:
    """The same on a stored table: its new state is published over the one it is read from."""
    old, new = states(t)
    table = "silver.rxlens_check_upsert"
    stored = layers.save_layer(old, "silver", "rxlens_check_upsert")
    return layers.publish(tables.upsert(stored, new, ["claim_id"]), table)


@query(
    "update_where",
    """
    SELECT claim_id, CASE claim_status WHEN 'pending' THEN 'approved'
                          ELSE claim_status END AS claim_status,
           CASE WHEN claim_status = 'pending' THEN 0.0 ELSE total_charge END AS total_charge
    FROM claims
    """,
)
def update_pending(t: StarTables) -> DataFrame:
    claims = claims_of(t).select("claim_id", "claim_status", "total_charge")
    pending = F.col("claim_status") == "pending"
    return tables.update_where(
        claims, pending, {"claim_status": F.lit("approved"), "total_charge": F.lit(0.0)}
    )


@query(
    "delete_where",
    "SELECT * FROM claims WHERE NOT coalesce(provider_id < 20, false)",
)
def delete_pharmacies(t: StarTables) -> DataFrame:
    """A range of pharmacies goes; claims without a pharmacy stay."""
    return tables.delete_where(t.claims(), F.col("provider_id") < 20)


CHANGES = f"""{STATES},
    feed AS (
      SELECT o.*, 'delete' AS _change FROM old_state o
      WHERE claim_id NOT IN (SELECT claim_id FROM new_state)
      UNION ALL
      SELECT n.*, 'insert' FROM new_state n
      WHERE claim_id NOT IN (SELECT claim_id FROM old_state)
      UNION ALL
      SELECT o.*, 'update_pre' FROM old_state o JOIN new_state n USING (claim_id)
      WHERE o.claim_status <> n.claim_status
      UNION ALL
      SELECT n.*, 'update_post' FROM old_state o JOIN new_state n USING (claim_id)
      WHERE o.claim_status <> n.claim_status)
"""


@query("change_feed", f"{CHANGES} SELECT * FROM feed")
def change_feed(t: StarTables) -> DataFrame:
    return tables.change_feed(*states(t), ["claim_id"])


@query("apply_changes", f"{STATES} SELECT * FROM new_state")
def apply_changes(t: StarTables) -> DataFrame:
    old, new = states(t)
    changes = stage_if_shared(tables.change_feed(old, new, ["claim_id"]))
    return tables.apply_changes(old, changes, ["claim_id"])


def history(t: StarTables) -> DataFrame:
    """Change history: a first load, then one batch, applied twice."""
    old, new = states(t)
    first = tables.change_feed(old.limit(0), old, ["claim_id"])
    second = stage_if_shared(tables.change_feed(old, new, ["claim_id"]))
    stamped = first.withColumn("batch_ts", F.lit(BATCHES[0]))
    once = tables.apply_history(stamped, second, BATCHES[1])
    return tables.apply_history(once, second, BATCHES[1])


@query(
    "apply_history",
    f"""{CHANGES}
    SELECT *, 'insert' AS _change, DATE '{BATCHES[0]}' AS batch_ts FROM old_state
    UNION ALL SELECT *, DATE '{BATCHES[1]}' FROM feed
    """,
)
def apply_history(t: StarTables) -> DataFrame:
    return history(t)


@query(
    "as_of",
    f"""{STATES}
    SELECT *, DATE '2001-05-01' AS seen_on, DATE '{BATCHES[0]}' AS batch_ts FROM old_state
    UNION ALL
    SELECT n.*, DATE '2001-12-31', CASE WHEN o.claim_status = n.claim_status
                                        THEN DATE '{BATCHES[0]}' ELSE DATE '{BATCHES[1]}' END
    FROM new_state n LEFT JOIN old_state o USING (claim_id)
    """,
)
def read_as_of(t: StarTables) -> DataFrame:
    past = history(t)
    days = (dt.date(2001, 5, 1), dt.date(2001, 12, 31))
    seen = [
        tables.as_of(past, ["claim_id"], "batch_ts", day).withColumn("seen_on", F.lit(day))
        for day in days
    ]
    return append_all(*seen)


# --- aggregation and windows ---------------------------------------------------------------


@query(
    "summarise",
    f"""
    SELECT channel, count(*) AS claim_count, {sum_cents('total_charge')} / 100.0 AS total_incurred,
           {quotient(sum_cents('total_charge'), 'count(total_charge) * 100')} AS avg_claim
    FROM {BY_CHANNEL} GROUP BY channel
    """,
)
def by_channel(t: StarTables) -> DataFrame:
    places = t.providers().select("provider_id", F.col("specialty").alias("channel"))
    measures = {
        "claim_count": F.count(F.lit(1)),
        "total_incurred": total_money("total_charge"),
        "avg_claim": average_money("total_charge"),
    }
    return summarise(t.claims().join(places, "provider_id", "left"), ["channel"], measures)


@query(
    "freq_two_way",
    """
    SELECT p.specialty, p.state, count(*) AS frequency
    FROM claims c LEFT JOIN providers p ON p.provider_id = c.provider_id GROUP BY 1, 2
    """,
)
def freq_two_way(t: StarTables) -> DataFrame:
    places = t.providers().select("provider_id", "specialty", "state")
    return freq(t.claims().join(places, "provider_id", "left"), "specialty", "state")


@query(
    "group_count",
    "SELECT plan_id, count(*) AS count FROM claims JOIN members USING (member_id) GROUP BY 1",
)
def group_count(t: StarTables) -> DataFrame:
    return claims_of(t).join(t.members(), "member_id").groupBy("plan_id").count()


@query(
    "count_when",
    """
    SELECT plan_id, count(*) FILTER (claim_status = 'approved') AS approved,
           count(*) FILTER (claim_status = 'denied') AS denied, count(*) AS total
    FROM claims JOIN members USING (member_id) GROUP BY plan_id
    """,
)
def status_by_plan(t: StarTables) -> DataFrame:
    joined = claims_of(t).join(t.members().select("member_id", "plan_id"), "member_id")
    return count_when(
        joined, ["plan_id"], "claim_status", {"approved": "approved", "denied": "denied"}
    )


@query(
    "members_over_total",
    f"""
    totals AS (SELECT member_id, {sum_cents('total_charge')} / 100.0 AS total,
                      min(claim_date) AS first_claim, max(claim_date) AS last_claim
               FROM claims GROUP BY member_id)
    SELECT * FROM totals WHERE total > 2000000
    """,
)
def members_over_total(t: StarTables) -> DataFrame:
    """Filter on an aggregate."""
    measures = {
        "total": total_money("total_charge"),
        "first_claim": F.min("claim_date"),
        "last_claim": F.max("claim_date"),
    }
    return summarise(claims_of(t), ["member_id"], measures).where("total > 2000000")


@query(
    "monthly",
    f"""
    SELECT {MONTH} AS claim_month, claim_status, count(*) AS row_count FROM claims GROUP BY 1, 2
    """,
)
def monthly_status(t: StarTables) -> DataFrame:
    return monthly(claims_of(t), "claim_date", ["claim_status"])


@query(
    "status_wide",
    f"""
    SELECT {MONTH} AS claim_month,
           {', '.join(f"count(*) FILTER (claim_status = '{s}') AS {s}"
                      for s in ('approved', 'denied', 'pending'))}
    FROM claims GROUP BY 1
    """,
)
def status_wide(t: StarTables) -> DataFrame:
    statuses = ["approved", "denied", "pending"]
    counts = monthly(claims_of(t), "claim_date", ["claim_status"])
    wide = to_wide(counts, ["claim_month"], "claim_status", statuses, "row_count")
    return wide.fillna(0, statuses)


@query(
    "approx_distinct_members",
    """
    SELECT plan_id, count(DISTINCT member_id) AS members,
           true AS estimate_is_near
    FROM claims JOIN members USING (member_id) GROUP BY plan_id
    """,
)
def approx_distinct_members(t: StarTables) -> DataFrame:
    """The exact distinct count, and whether the cheap estimate is within a tenth of it."""
    joined = claims_of(t).join(t.members().select("member_id", "plan_id"), "member_id")
    exact, near = F.count_distinct("member_id"), F.approx_count_distinct("member_id", 0.02)
    return summarise(
        joined, ["plan_id"], {"members": exact, "estimate_is_near": F.abs(near - exact) <= exact / 10}
    )


MONTHS_BY_STATUS = f"""
    months AS ({month_totals('claims', 'claim_status')}),
    priced AS (SELECT claim_month, claim_status, claim_count, cents / 100.0 AS spend, cents
               FROM months)
"""


def months_by_status(t: StarTables) -> DataFrame:
    months = gold.month_totals(claims_of(t), ["claim_status"])
    return months.select(
        "claim_month", "claim_status", "claim_count", (F.col("cents") / 100.0).alias("spend")
    )


BY = ["claim_status"]


@query(
    "running_total",
    f"""{MONTHS_BY_STATUS}
    SELECT claim_month, claim_status, claim_count, spend,
           CAST(sum(cents) OVER (PARTITION BY claim_status ORDER BY claim_month) AS BIGINT) / 100.0
             AS spend_to_date
    FROM priced
    """,
)
def spend_to_date(t: StarTables) -> DataFrame:
    return running_total(months_by_status(t), "claim_month", "spend", BY, "spend_to_date")


@query(
    "lead_month",
    f"""{MONTHS_BY_STATUS}
    SELECT claim_month, claim_status, claim_count, spend,
           lead(spend, 1) OVER (PARTITION BY claim_status ORDER BY claim_month) AS next_spend
    FROM priced
    """,
)
def lead_month(t: StarTables) -> DataFrame:
    return with_lead(months_by_status(t), "claim_month", "spend", 1, BY, "next_spend")


@query(
    "lag_growth",
    f"""{MONTHS_BY_STATUS},
    lagged AS (
      SELECT *, lag(spend, 12) OVER (PARTITION BY claim_status ORDER BY claim_month) AS spend_lag_12
      FROM priced)
    SELECT claim_month, claim_status, claim_count, spend, spend_lag_12,
           {half_up('(spend - spend_lag_12) / nullif(spend_lag_12, 0) * 100')} AS growth_pct
    FROM lagged
    """,
)
def lag_growth(t: StarTables) -> DataFrame:
    lagged = with_lag(months_by_status(t), "claim_month", "spend", 12, BY)
    return growth_pct(lagged, "claim_month", "spend", 12, BY)


FRAME = "(PARTITION BY claim_status ORDER BY claim_month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


@query(
    "moving_avg",
    f"""{MONTHS_BY_STATUS}
    SELECT claim_month, claim_status, claim_count, spend,
           {half_up(f'CAST(sum(cents) OVER {FRAME} AS DOUBLE) / (count(*) OVER {FRAME} * 100)')}
             AS moving_avg_6
    FROM priced
    """,
)
def half_year_average(t: StarTables) -> DataFrame:
    return moving_avg(months_by_status(t), "claim_month", "spend", 6, BY)


@query(
    "share_of_month",
    f"""{MONTHS_BY_STATUS}
    SELECT claim_month, claim_status, claim_count, spend,
           {quotient('claim_count * 100.0::DOUBLE',
                     'sum(claim_count) OVER (PARTITION BY claim_month)')} AS share_pct
    FROM priced
    """,
)
def share_of_month(t: StarTables) -> DataFrame:
    return share_pct(months_by_status(t), "claim_count", ["claim_month"])


# --- data quality ----------------------------------------------------------------------------


RULES_DAY = "2000-12-31"


def rules() -> dict:
    return quality.claim_rules(RULES_DAY) | {"no_pharmacy": F.col("provider_id").isNull()}


@query(
    "dq_counts",
    f"""
    counted AS (
      SELECT count(*) FILTER (claim_id IS NULL) AS a, count(*) FILTER (total_charge < 0) AS b,
             count(*) FILTER (claim_date > DATE '{RULES_DAY}') AS c,
             count(*) FILTER (provider_id IS NULL) AS d, count(*) AS n FROM claims)
    SELECT 'null_claim_ids' AS rule, a AS violations, n AS rows_checked FROM counted
    UNION ALL SELECT 'negative_charges', b, n FROM counted
    UNION ALL SELECT 'future_dates', c, n FROM counted
    UNION ALL SELECT 'no_pharmacy', d, n FROM counted
    """,
)
def dq_counts(t: StarTables) -> DataFrame:
    return quality.dq_counts(t.claims(), rules())


@query(
    "enforce",
    f"""
    SELECT * FROM claims WHERE claim_id IS NOT NULL AND total_charge >= 0
       AND claim_date <= DATE '{RULES_DAY}' AND provider_id IS NOT NULL
    """,
)
def valid_claims(t: StarTables) -> DataFrame:
    return quality.enforce(t.claims(), rules())[0]


@query(
    "enforce_rejected",
    f"""
    SELECT claim_id, concat_ws(',',
             CASE WHEN claim_date > DATE '{RULES_DAY}' THEN 'future_dates' END,
             CASE WHEN provider_id IS NULL THEN 'no_pharmacy' END) AS reasons
    FROM claims WHERE claim_date > DATE '{RULES_DAY}' OR provider_id IS NULL
    """,
)
def rejected_claims(t: StarTables) -> DataFrame:
    bad = quality.enforce(t.claims(), rules())[1]
    return bad.select("claim_id", F.array_join(quality.VIOLATIONS, ",").alias("reasons"))


@query(
    "orphans",
    "SELECT * FROM claims WHERE claim_id NOT IN (SELECT claim_id FROM procedures)",
)
def claims_without_lines(t: StarTables) -> DataFrame:
    return quality.orphans(t.claims(), t.procedures(with_desc=False), "claim_id")


@query(
    "stage_counts",
    f"""
    SELECT 'raw' AS stage, count(*) AS row_count FROM claims
    UNION ALL SELECT 'decided', count(*) FROM claims WHERE claim_status <> 'pending'
    UNION ALL SELECT 'of_plan', count(*) FROM claims WHERE claim_status <> 'pending'
      AND member_id IN (SELECT member_id FROM members WHERE plan_id = '{PLAN}')
    """,
)
def stage_counts(t: StarTables) -> DataFrame:
    raw = claims_of(t)
    decided = raw.where("claim_status <> 'pending'")
    of_plan = joins.members_in_plan(decided, t.members(), PLAN)
    return quality.stage_counts({"raw": raw, "decided": decided, "of_plan": of_plan})


PAST = "(PARTITION BY channel ORDER BY claim_month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"


@query(
    "flag_anomalies",
    f"""
    months AS ({month_totals(BY_CHANNEL, 'channel')}),
    past AS (
      SELECT claim_month, channel, claim_count,
             {half_up(f'avg(claim_count) OVER {PAST}', 4)} AS past_mean,
             {half_up(f'stddev_samp(claim_count) OVER {PAST}', 4)} AS past_stddev
      FROM months),
    scored AS (
      SELECT *, {half_up('(claim_count - past_mean) / nullif(past_stddev, 0)', 4)} AS z_score
      FROM past)
    SELECT *, coalesce(abs(z_score) > 2.5, false) AS is_anomaly FROM scored
    """,
)
def anomalies(t: StarTables) -> DataFrame:
    months = gold.channel_months(t.claims(), t.providers()).drop("cents")
    return flag_anomalies(months, "claim_month", "claim_count", ["channel"], 6, 2.5)


@query(
    "mark_immature",
    f"""
    SELECT {MONTH} AS claim_month, count(*) AS row_count,
           {MONTH} > DATE '2001-05-01' AS is_immature
    FROM claims GROUP BY 1
    """,
)
def immature_months(t: StarTables) -> DataFrame:
    months = monthly(claims_of(t), "claim_date")
    return quality.mark_immature(months, "claim_month", "2001-08-15", 3)


@query(
    "cached_branches",
    """
    joined AS (SELECT c.claim_id, m.plan_id FROM claims c
               JOIN members m ON m.member_id = c.member_id
               WHERE c.total_charge > 250000)
    SELECT plan_id, count(*) AS claims, (SELECT count(*) FROM joined) AS all_claims
    FROM joined GROUP BY plan_id
    """,
)
def cached_branches(t: StarTables) -> DataFrame:
    """One filtered join, cached while two reports are taken from it."""
    joined = (
        claims_of(t)
        .where("total_charge > 250000")
        .join(t.members().select("member_id", "plan_id"), "member_id")
        .select("claim_id", "plan_id")
    )
    with cached(joined) as kept:
        total = kept.agg(F.count(F.lit(1)).alias("all_claims"))
        by_plan = kept.groupBy("plan_id").agg(F.count(F.lit(1)).alias("claims"))
        return checkpoint_stage(joins.with_scalars(by_plan, total))
