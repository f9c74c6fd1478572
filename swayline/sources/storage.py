"""Shared working storage: cut a lineage by writing a table every executor can read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BROADCAST_ROWS = 100_000  # of a table; beyond that it is dealt by key


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local folder only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="swayline-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    Several passes then read a narrow columnar table rather than redoing joins and aggregates, and a lost
    executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_rows(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side`` of a join, broadcast up to ``rows`` (``BROADCAST_ROWS``) rows and dealt by key beyond.

    Spark's estimate is the size of compressed files; a table of a few MB on disk can be hundreds in the driver.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    return side.hint("broadcast" if side.limit(rows + 1).count() <= rows else "merge")
