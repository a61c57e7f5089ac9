"""Load only the files that were not loaded before.

A file stream with ``availableNow`` finds the new files; its checkpoint remembers the old
ones. Every micro-batch replaces its own ``load_id`` partition of the target, named after
the checkpoint and the batch number, so a batch that is retried after a crash leaves no
half-written and no double rows. A load is one batch: all of its files become visible when
its write commits, or none. Files are told by name, never by age, so one that arrives late or
keeps an old modification time is loaded like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from rxlens.values import CODEC

LOAD_ID = "load_id"
#: Names of the text of a row that did not parse, and of its file, while a load runs.
RECORD, SOURCE = "_corrupt_record", "_source_file"
REJECTS = f"record STRING, reasons ARRAY<STRING>, source_file STRING, {LOAD_ID} STRING"
#: Spark ignores files older than this against the newest one seen; no file may be.
ANY_AGE = "36500d"


def ingest_incremental(
    spark: SparkSession,
    src: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    sep: str = ",",
    file_format: str = "csv",
    rejects: str | None = None,
) -> int:
    """Append the rows of new files under ``src`` to ``target``; returns rows added.

    ``transform`` selects or derives columns on the way. ``file_format`` is any file
    source of Spark. The header of a CSV file must name the schema's columns in order,
    else the load fails as a whole. For a feed with a new column, call again with the
    longer schema and the same checkpoint.

    With ``rejects`` (CSV and JSON), rows that do not parse (a value of the wrong type, too few
    or too many fields) do not enter the target with nulls in place of values, but go under that
    folder with their text, file and reason; ``read_rejects`` reads them. Loaded and rejected
    rows add up to the lines of the files. ``transform`` then sees good rows alone, after they
    were parsed.
    """
    if rejects is not None:
        return _ingest_checked(
            spark, src, target, schema, checkpoint, transform, sep, file_format, rejects
        )
    added = 0

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal added
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{stream_id}-{batch_id:010d}"
        seen = Observation()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        folder = f"{target.rstrip('/')}/{LOAD_ID}={load_id}"
        counted.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        added += seen.get["rows"]

    feed = _reader(spark, schema, sep, file_format).load(src)
    if transform is not None:
        feed = feed.transform(transform)
    _run(feed, write_batch, checkpoint)
    return added


def _reader(
    spark: SparkSession, schema: T.StructType, sep: str, file_format: str
) -> DataStreamReader:
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if file_format == "csv":
        reader = reader.options(header=True, sep=sep, enforceSchema=False)
    return reader.format(file_format)


def _run(feed: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        feed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _ingest_checked(
    spark: SparkSession,
    src: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None,
    sep: str,
    file_format: str,
    rejects: str,
) -> int:
    """``ingest_incremental`` that keeps rows that do not parse apart.

    A load's files are read twice, for its bad rows and for its good ones. The bad ones are
    written first, so a load that can be seen has its rejects beside it.
    """
    if file_format not in ("csv", "json"):
        raise ValueError(f"rejects need a text format, not {file_format}")
    added = 0
    names = [field.name for field in schema]
    if {RECORD, SOURCE} & set(names):
        raise ValueError(f"the feed may not have columns called {RECORD} or {SOURCE}")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal added
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"{LOAD_ID}={stream_id}-{batch_id:010d}"
        good, bad = F.col(RECORD).isNull(), F.col(RECORD).isNotNull()
        rejected = batch.where(bad).select(
            F.col(RECORD).alias("record"),
            (csv_reasons(schema, sep) if file_format == "csv" else F.array(F.lit("record"))).alias(
                "reasons"
            ),
            F.col(SOURCE).alias("source_file"),
        )
        # An empty folder takes the place of one that an earlier attempt may have left.
        rejected.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/{load}")
        seen = Observation()
        kept = batch.where(good).select(*[F.col(f"`{name}`") for name in names])
        kept = kept if transform is None else kept.transform(transform)
        counted = kept.observe(seen, F.count(F.lit(1)).alias("rows"))
        folder = f"{target.rstrip('/')}/{load}"
        counted.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        added += seen.get["rows"]

    wide = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = _reader(spark, wide, sep, file_format)
    # All columns are parsed, also where the target keeps a few: one that is not read never fails.
    feed = reader.options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, columnPruning=False
    ).load(src)
    _run(feed.withColumn(SOURCE, F.col("_metadata.file_path")), write_batch, checkpoint)
    return added


def csv_reasons(schema: T.StructType, sep: str = ",") -> Column:
    """Why a CSV record did not parse: ``field count``, or the columns whose text is no value.

    The record is split again with all columns as text; a column that has text but came out
    null did not parse.
    """
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    shape = T.StructType([*texts.fields, T.StructField(RECORD, T.StringType())])
    again = F.from_csv(
        F.col(RECORD),
        ", ".join(f"{f.name} STRING" for f in shape),
        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD},
    )
    failed = [
        F.when(F.col(f"`{field.name}`").isNull() & again[f"c{i}"].isNotNull(), F.lit(field.name))
        for i, field in enumerate(schema)
    ]
    uneven = again[RECORD].isNotNull()
    return F.when(uneven, F.array(F.lit("field count"))).otherwise(F.array_compact(F.array(*failed)))


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """``record``, ``reasons``, ``source_file`` and ``load_id`` of every rejected row."""
    return spark.read.schema(REJECTS).parquet(rejects)


def read_ingested(
    spark: SparkSession, target: str, schema: T.StructType | None = None
) -> DataFrame:
    """The loaded rows; columns that older loads lacked are NULL there.

    Give the feed's schema where the target is large. Without it the schemas of all files
    are merged, which opens every file first.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(target)
    return spark.read.schema(schema).parquet(target)
