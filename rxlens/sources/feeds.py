"""Raw feeds: schemas, batch reads, full loads and load audit."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


FEEDS: dict[str, T.StructType] = {
    "members": T.StructType(
        [
            *_texts("member_id", "first_name", "last_name"),
            T.StructField("birth_date", T.DateType()),
            *_texts("gender", "plan_id"),
            T.StructField("effective_date", T.DateType()),
        ]
    ),
    "claims": T.StructType(
        [
            *_texts("claim_id", "member_id", "provider_id"),
            T.StructField("claim_date", T.DateType()),
            T.StructField("total_charge", T.DoubleType()),
            *_texts("claim_status"),
        ]
    ),
    "providers": T.StructType(
        _texts("provider_id", "npi", "provider_name", "specialty", "address", "city", "state")
    ),
    "procedures": T.StructType(_texts("claim_id", "procedure_code", "procedure_desc", "amount")),
}


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """Read a CSV feed. Without a schema Spark infers one, at the cost of an extra pass.

    With a schema the header must name its columns in order: a reordered file fails
    instead of shifting values into the wrong columns.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", not header).csv(path)


def schema_once(spark: SparkSession, path: str, kept: str) -> T.StructType:
    """The schema kept as JSON under ``kept``; at first it is inferred from the feed and kept."""
    try:
        text = spark.read.text(kept, wholetext=True).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = read_feed(spark, path).schema
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(kept)
        return schema
    return T.StructType.fromJson(json.loads(text))


def ingest_full(
    spark: SparkSession,
    src: str,
    target: str,
    schema: T.StructType | None = None,
    mode: str = "overwrite",
) -> None:
    """Load every file again, whether loaded before or not."""
    read_feed(spark, src, schema).write.mode(mode).parquet(target)


def with_lineage(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the name of the file that each row was read from (batch or stream)."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def feed_inventory(df: DataFrame) -> DataFrame:
    """Rows and size of each source file behind ``df``."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def export_csv(
    df: DataFrame, path: str, mode: str = "error", compression: str = "none"
) -> None:
    """Write a table as CSV files with a header, one file per task.

    With ``compression="gzip"`` they take about a third; a reader takes such a file in one task.
    """
    df.write.mode(mode).options(header=True, compression=compression).csv(path)
