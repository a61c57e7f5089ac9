"""Adapter: claims entities out of an order-management star schema.

Orders play claim headers, customers members, suppliers pharmacies and order lines drug
lines. The mapping is a rule per column, so any scale of the star schema works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rxlens.functions import map_code
from rxlens.values import CHANNEL_CODES, UNKNOWN_LABEL

AS_OF = "2001-12-31"

# --- fixed values of the mapping -----------------------------------------------------
STATUS_OF_ORDER = {"F": "approved", "O": "pending", "P": "denied"}
CHANNEL_CODE_OF_REMAINDER = ("R", "M", "S")

_SCHEMAS: dict[tuple[str, str], StructType] = {}


class StarTables:
    """Lazy entities over a folder of Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """Scan a table. Its schema is read from a file footer once per session."""
        path = f"{self.sf_dir}/{name}.parquet"
        seen = (self.spark.sparkContext.applicationId, path)
        if seen not in _SCHEMAS:
            _SCHEMAS[seen] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[seen]).parquet(path)

    def claims(self, with_provider: bool = True) -> DataFrame:
        """Claim headers. The pharmacy is the lowest supplier on the order's lines, so an
        order without lines has none; leave it out where it is not needed."""
        orders = self.table("orders")
        columns = [
            F.col("o_orderkey").alias("claim_id"),
            F.col("o_custkey").alias("member_id"),
            F.to_date("o_orderdate").alias("claim_date"),
            F.col("o_totalprice").alias("total_charge"),
            _status(F.col("o_orderstatus")).alias("claim_status"),
        ]
        if not with_provider:
            return orders.select(*columns)
        supplier = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_suppkey").alias("provider_id"))
        )
        columns.insert(2, F.col("provider_id"))
        return orders.join(supplier, "o_orderkey", "left").select(*columns)

    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("member_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            _days_after("1925-01-01", key * 7919 % 30000).alias("birth_date"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_mktsegment").alias("plan_id"),
            _days_after("1994-01-01", key % 365).alias("effective_date"),
        )

    def providers(self) -> DataFrame:
        key = F.col("s_suppkey")
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state")
        )
        return (
            self.table("supplier")
            .join(nations, "s_nationkey", "left")
            .select(
                key.alias("provider_id"),
                F.lpad(key.cast("string"), 10, "0").alias("npi"),
                F.col("s_name").alias("provider_name"),
                _channel(key).alias("specialty"),
                F.concat(F.lit("Unit "), key.cast("string")).alias("address"),
                F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("city"),
                "state",
            )
        )

    def procedures(self, with_desc: bool = True) -> DataFrame:
        """Drug lines; leave the description out where it is not needed."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("claim_id"),
            F.col("l_partkey").alias("procedure_code"),
            (F.floor(F.col("l_extendedprice") * 2).cast("double") / 100).alias("amount"),
        )
        if not with_desc:
            return lines
        parts = self.table("part").select(
            F.col("p_partkey").alias("procedure_code"), F.col("p_name").alias("procedure_desc")
        )
        return lines.join(parts, "procedure_code", "left").select(
            "claim_id", "procedure_code", "procedure_desc", "amount"
        )


def _status(code: Column) -> Column:
    label = F.lit(None).cast("string")
    for key, value in STATUS_OF_ORDER.items():
        label = F.when(code == key, value).otherwise(label)
    return label


def channel_code(key: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(code) for code in CHANNEL_CODE_OF_REMAINDER]), (key % 3 + 1).cast("int")
    )


def _channel(key: Column) -> Column:
    return map_code(channel_code(key), CHANNEL_CODES, UNKNOWN_LABEL)


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))
