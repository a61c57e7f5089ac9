"""The registry, and the SQL the oracles share.

An oracle is standard SQL over the star-schema tables. It starts with the claims entities
as common table expressions, the same rules as ``rxlens.sources.star``, and goes on with
the query's own text: either a SELECT, or further ``name AS (...)`` expressions first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rxlens.sources.star import StarTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ENTITIES = """
claims AS (
  SELECT o.o_orderkey AS claim_id, o.o_custkey AS member_id, s.provider_id,
         CAST(o.o_orderdate AS DATE) AS claim_date, o.o_totalprice AS total_charge,
         CASE o.o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending'
                              WHEN 'P' THEN 'denied' END AS claim_status
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS provider_id
             FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey),
members AS (
  SELECT c_custkey AS member_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         CAST(DATE '1925-01-01' + CAST(c_custkey * 7919 % 30000 AS INTEGER) AS DATE) AS birth_date,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         c_mktsegment AS plan_id,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS effective_date
  FROM customer),
providers AS (
  SELECT s_suppkey AS provider_id, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS npi,
         s_name AS provider_name,
         CASE s_suppkey % 3 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Mail Order'
                            ELSE 'Specialty' END AS specialty,
         'Unit ' || s_suppkey AS address, 'City ' || s_nationkey AS city, n_name AS state
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey),
procedures AS (
  SELECT l_orderkey AS claim_id, l_partkey AS procedure_code, p_name AS procedure_desc,
         floor(l_extendedprice * 2) / 100 AS amount
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)
"""


def half_up(expr: str, scale: int = 2) -> str:
    """Round a double by its decimal text, half away from zero, as Spark's ROUND does."""
    text = f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({text}, {scale}) AS DOUBLE)"


def whole_cents(amount: str) -> str:
    return f"CAST(floor({amount} * 100 + 0.5) AS BIGINT)"


def sum_cents(amount: str) -> str:
    return f"CAST(sum({whole_cents(amount)}) AS BIGINT)"


def quotient(num: str, den: str, scale: int = 2) -> str:
    return half_up(f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)", scale)


def query(name: str, oracle: str | None = None) -> Callable:
    """Register ``function(tables) -> DataFrame`` under ``name``."""

    def register(function: Callable[[StarTables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(StarTables(spark, sf_dir))

        run.__module__ = function.__module__
        QUERIES[name] = run
        if oracle is not None:
            text = oracle.strip()
            glue = "" if text.upper().startswith("SELECT") else ","
            ORACLES[name] = f"WITH {ENTITIES.strip()}{glue}\n{text}"
        return function

    return register
