"""Layer tables: bronze, silver and gold databases of Parquet tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rxlens.values import CODEC

LAYERS = ("bronze", "silver", "gold")
#: Folder name of a partition whose value is null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def save_layer(
    df: DataFrame,
    layer: str,
    name: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    comment: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Store a table in a layer and return the stored copy.

    ``partition_by`` should have few values (a month, not a day). Rows are gathered by
    partition first, so a task does not open one file per value; adaptive execution
    splits a value that holds many rows over several tasks. Values whose folder names need
    escapes (with a slash, colon or percent sign) are not meant for it. A failed overwrite leaves the
    table as it was; see ``publish``.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    table = f"{layer}.{name}"
    partitions = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    if mode == "overwrite":
        publish(df, table, partitions, path)
    else:
        writer = _gathered(df, partitions).write
        writer = writer.partitionBy(*partitions) if partitions else writer
        if path is not None and not spark.catalog.tableExists(table):
            writer = writer.option("path", path)
        writer.format("parquet").mode(mode).saveAsTable(table)
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    return spark.table(table)


def _gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(column) for column in partitions]) if partitions else df


def publish(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    gathered: bool = False,
) -> DataFrame:
    """Make ``df`` the new state of a stored table.

    The rows go to a fresh folder first (under ``path``, or in the warehouse); the table is
    pointed there when the write is done. So ``df`` may read the table itself, a write that
    fails changes nothing, and the files of the state before stay for plans that still read
    them, until the owner of the folder expires them. A partitioned table changes partition by
    partition and exists throughout. One writer at a time. ``gathered``: the rows already lie
    together by partition, as after ``repartitionByRange``, and are written as they lie.
    """
    spark = df.sparkSession
    quoted = _quoted(table)
    fresh = _write_fresh(df, table, partition_by, path, gathered)
    stored = spark.read.schema(df.schema).parquet(fresh)
    exists = spark.catalog.tableExists(table)
    same = exists and sorted(spark.table(table).dtypes) == sorted(df.dtypes)
    if same and not partition_by and _described(spark, table, "Type") == "EXTERNAL":
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{fresh}'")
    elif same and partition_by and _by_catalog(spark, table, partition_by):
        now = _point_partitions(stored, table, partition_by)
        # Partitions that an append makes go below the new folder: not beside files of a state
        # before, which would come back with them.
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{fresh}'")
        for spec in _partitions(spark, table) - now:
            spark.sql(f"ALTER TABLE {quoted} DROP IF EXISTS PARTITION ({_spec_sql(spec)})")
    else:
        # Another schema, or a table that owns its files: make it anew at the new files, which
        # are complete.
        if exists:
            spark.sql(f"DROP TABLE {quoted}")
        if partition_by:
            _create_partitioned(df, table, partition_by, path)
            _point_partitions(stored, table, partition_by)
        else:
            spark.catalog.createTable(table, path=fresh, source="parquet")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def replace_partitions(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str],
    path: str | None = None,
    gathered: bool = False,
) -> DataFrame:
    """Make ``df`` the new content of the partitions it has rows in; the others stay as they are.

    Written and pointed to as in ``publish``: ``df`` may read the partitions that it replaces,
    and only the touched ones get new files. The table is made if there is none. A crash half
    way leaves each partition in its old or its new state; run the same replacement again.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return publish(df, table, partition_by, path, gathered)
    if sorted(spark.table(table).dtypes) != sorted(df.dtypes):
        raise ValueError(f"{table} has other columns than the rows that replace its partitions")
    fresh = _write_fresh(df, table, partition_by, path, gathered)
    _point_partitions(spark.read.schema(df.schema).parquet(fresh), table, partition_by)
    spark.catalog.refreshTable(table)
    return spark.table(table)


#: Partition columns and their values as text; None for null.
Spec = tuple[tuple[str, str | None], ...]


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _write_fresh(
    df: DataFrame, table: str, partition_by: Sequence[str], path: str | None, gathered: bool
) -> str:
    base = path or f"{df.sparkSession.conf.get('spark.sql.warehouse.dir')}/_tables/{table}"
    fresh = f"{base.rstrip('/')}/state-{uuid.uuid4().hex}"
    writer = (df if gathered else _gathered(df, partition_by)).write
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.mode("error").option("compression", CODEC).parquet(fresh)
    return fresh


def _create_partitioned(
    df: DataFrame, table: str, partition_by: Sequence[str], path: str | None
) -> None:
    """A table without partitions yet; each of them names its own folder."""
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir')}/_tables/{table}"
    columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
    by = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE {_quoted(table)} ({columns}) USING parquet PARTITIONED BY ({by}) "
        f"LOCATION '{base.rstrip('/')}/unpartitioned'"
    )


def _described(spark: SparkSession, table: str, item: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == item), None)


def _by_catalog(spark: SparkSession, table: str, partition_by: Sequence[str]) -> bool:
    """The catalog lists the partitions, by these columns, and dropping one keeps its files."""
    named = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return (
        named == list(partition_by)
        and _described(spark, table, "Partition Provider") == "Catalog"
        and _described(spark, table, "Type") == "EXTERNAL"
    )


def _partitions(spark: SparkSession, table: str) -> set[Spec]:
    def spec(text: str) -> Spec:
        pairs = [part.split("=", 1) for part in text.split("/")]
        return tuple((k, None if v == NO_VALUE else v) for k, v in pairs)

    return {spec(r[0]) for r in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()}


def _spec_sql(spec: Spec) -> str:
    return ", ".join(f"`{k}` = " + ("NULL" if v is None else f"'{v}'") for k, v in spec)


def _point_partitions(stored: DataFrame, table: str, partition_by: Sequence[str]) -> set[Spec]:
    """Let the table's partitions name the folders of ``stored``, and return them."""
    spark = stored.sparkSession
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    values = [F.col(f"`{c}`").cast("string") for c in partition_by]
    # One row per partition written.
    folders = stored.select(*values, folder.alias("folder")).distinct().collect()
    known = _partitions(spark, table)
    quoted, now, added = _quoted(table), set(), []
    for *texts, where in folders:
        spec = tuple(zip(partition_by, texts))
        now.add(spec)
        if spec in known:
            spark.sql(f"ALTER TABLE {quoted} PARTITION ({_spec_sql(spec)}) SET LOCATION '{where}'")
        else:
            added.append(f"PARTITION ({_spec_sql(spec)}) LOCATION '{where}'")
    if added:
        spark.sql(f"ALTER TABLE {quoted} ADD IF NOT EXISTS {' '.join(added)}")
    return now


def insert_rows(spark: SparkSession, table: str, rows: Sequence[Row | tuple]) -> None:
    """Append a few literal rows to a stored table."""
    schema = spark.table(table).schema
    spark.createDataFrame(list(rows), schema).write.insertInto(table)


def compact(
    spark: SparkSession,
    src: str,
    path: str,
    n_files: int | None = None,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite a Parquet folder into fewer files, sorted so that filters skip files.

    Rows are spread by range of the clustering columns and sorted within each file, so
    Parquet's min and max become narrow. The place of a row in its old file is the last
    range key: it splits a value, or a group of equal rows, that is too large for one
    task, and unlike a random number it is the same when a lost task runs again. Without
    ``n_files`` adaptive execution picks the number from the data size. ``path`` must be
    new; swap it in when the write is done.
    """
    df = spark.read.parquet(src)
    if cluster_by:
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        placed = df.select("*", place.alias("__place"))
        spread = [*cluster_by, "__place"]
        parted = (
            placed.repartitionByRange(n_files, *spread)
            if n_files
            else placed.repartitionByRange(*spread)
        )
        df = parted.sortWithinPartitions(*cluster_by).drop("__place")
    else:
        df = df.repartition(n_files) if n_files else df.hint("rebalance")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def write_history(
    changes: DataFrame, path: str, batch_ts: dt.datetime | dt.date, ts_col: str = "batch_ts"
) -> None:
    """Append a batch to a history table; writing the same batch again replaces it.

    The batch's own partition folder is overwritten, so an empty batch empties it.
    """
    stamp = F.lit(batch_ts).cast("string")
    value = changes.sparkSession.range(1).select(stamp).first()[0].replace(":", "%3A")
    changes.drop(ts_col).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{ts_col}={value}")
