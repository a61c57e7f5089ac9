"""Reuse of intermediate results, and where they are kept."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors reach, as the cluster names it; None when it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run, inside the shared folder.

    Where the session names no such folder it lies in the warehouse, which every executor
    of a session reaches as well.
    """
    base = shared_dir(spark) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for several actions and release it afterwards. Filter before caching."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def checkpoint_stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a stage as Parquet and go on from the files.

    The plan that follows starts at a columnar scan with known sizes, and a lost executor
    costs nothing that was already written.
    """
    path = path or scratch_path(df.sparkSession, "stage")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_if_shared(df: DataFrame) -> DataFrame:
    """``checkpoint_stage`` where the cluster names a shared folder, else ``df`` itself.

    For a result that several branches of one plan read: on a cluster it is worked out
    once, in a small session the plan stays lazy.
    """
    return df if shared_dir(df.sparkSession) is None else checkpoint_stage(df)
