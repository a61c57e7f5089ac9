"""Silver tables over raw feeds made from the star tables: padded, retyped, delivered twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.checks.registry import half_up, query
from rxlens.operators.aggregates import freq
from rxlens.plans.silver import (
    silver_claims,
    silver_members,
    silver_procedures,
    silver_providers,
)
from rxlens.sources.star import StarTables


def twice(df: DataFrame) -> DataFrame:
    return df.unionByName(df)


def raw_procedures(t: StarTables) -> DataFrame:
    """Amounts as money text, codes in lower case between blanks."""
    return t.procedures().select(
        "claim_id",
        F.concat(F.lit(" ndc"), F.col("procedure_code").cast("string"), F.lit(" ")).alias(
            "procedure_code"
        ),
        F.concat(F.lit(" "), "procedure_desc").alias("procedure_desc"),
        F.concat(F.lit("$"), F.format_number("amount", 2)).alias("amount"),
    )


@query(
    "silver_members",
    """
    SELECT DISTINCT CAST(member_id AS VARCHAR) AS member_id, trim(first_name) AS first_name,
           trim(last_name) AS last_name, birth_date, gender, plan_id, effective_date
    FROM members
    """,
)
def members(t: StarTables) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("last_name"), F.lit("  "))
    raw = t.members().withColumns(
        {
            "last_name": padded,
            "birth_date": F.col("birth_date").cast("string"),
            "effective_date": F.col("effective_date").cast("string"),
        }
    )
    return silver_members(twice(raw))


@query(
    "silver_claims",
    f"""
    SELECT DISTINCT claim_id, CAST(member_id AS VARCHAR) AS member_id, provider_id, claim_date,
           {half_up('total_charge')} AS total_charge, lower(claim_status) AS claim_status
    FROM claims WHERE total_charge > 0
    """,
)
def claims(t: StarTables) -> DataFrame:
    raw = t.claims().withColumns(
        {
            "claim_status": F.upper("claim_status"),
            "claim_date": F.col("claim_date").cast("string"),
        }
    )
    return silver_claims(twice(raw))


@query("silver_providers", "SELECT DISTINCT * FROM providers")
def providers(t: StarTables) -> DataFrame:
    return silver_providers(twice(t.providers()))


SILVER_PROCEDURES = f"""
    cleaned AS (
      SELECT claim_id, upper(trim(' ndc' || procedure_code || ' ')) AS procedure_code,
             trim(' ' || procedure_desc) AS procedure_desc,
             CAST(regexp_replace('$' || format('{{:,.2f}}', amount), '[^0-9.]', '', 'g')
                  AS DOUBLE) AS amount
      FROM procedures),
    best AS (
      SELECT claim_id, procedure_code, max(amount) AS amount FROM cleaned
      WHERE amount > 0 GROUP BY claim_id, procedure_code),
    silver AS (
      SELECT b.claim_id, b.procedure_code, min(c.procedure_desc) AS procedure_desc, b.amount,
             CASE WHEN b.amount < 100 THEN 'Low' WHEN b.amount < 500 THEN 'Medium'
                  WHEN b.amount < 1000 THEN 'High' ELSE 'Very High' END AS cost_category
      FROM best b JOIN cleaned c USING (claim_id, procedure_code, amount)
      GROUP BY b.claim_id, b.procedure_code, b.amount)
"""


@query("silver_procedures", f"{SILVER_PROCEDURES} SELECT * FROM silver")
def procedures(t: StarTables) -> DataFrame:
    return silver_procedures(raw_procedures(t))


@query(
    "cost_category_freq",
    f"{SILVER_PROCEDURES} SELECT cost_category, count(*) AS line_count FROM silver GROUP BY 1",
)
def cost_category_freq(t: StarTables) -> DataFrame:
    return freq(silver_procedures(raw_procedures(t)), "cost_category", name="line_count")
