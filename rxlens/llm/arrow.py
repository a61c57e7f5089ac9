"""Row functions over Arrow batches, for operators that look at one text at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of a schema like ``"a long, b string"``."""
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), TYPES[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, so that few texts are held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def plain_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, null texts empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def map_texts(
    docs: DataFrame, start: Callable[[], Callable[[str], tuple]], schema: str
) -> DataFrame:
    """``doc_id`` and the values of a row function for every whole text.

    ``start`` makes the row function, once per task.
    """
    whole = f"doc_id long, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = None
        for batch in batches:
            row = row or start()
            pairs = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            yield batch_of([(doc_id, *row(text)) for doc_id, text in pairs], whole)

    return plain_texts(docs).mapInArrow(run, whole)


def text_mark(doc_id: Column, text: Column) -> Column:
    """Names a row's text together with its id, where ids repeat."""
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit("")))


def agreed_labels(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id`` and the label as a flag, for ids whose label rows all say the same."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("label"))
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.min("label").alias("a"), F.max("label").alias("b"))
        .filter("a = b")
        .select("doc_id", (F.col("a") > 0).alias(column))
    )
