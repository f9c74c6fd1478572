"""A local session for tests, checks and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("swayline")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory).config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark
