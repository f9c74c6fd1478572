"""The four member tables, derived from a star schema of customers, orders, parts, events and pages."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from swayline.config import FeatureConfig
from swayline.sources.storage import by_rows
from swayline.sources.tables import MemberTables

STAR_CONFIG = FeatureConfig(
    own_domain_token="example.com",
    reference_date=date(2002, 1, 1),
    mid_date=date(2024, 1, 16),
    default_date=date(2024, 1, 1),
    claims_mid_date=date(1998, 7, 1),
    priority_codes=tuple(f"Brand#{i}" for i in range(1, 11)),
    category_column="icd_group",
)


TASK_LINES = 1 << 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def members(spark: SparkSession, folder: str) -> DataFrame:
    """Orders shrink to one row per customer before the join, so a customer with many orders costs nothing."""
    spans = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("member_id")).agg(
        F.min("o_orderdate").alias("signup_date"), F.max("o_orderdate").alias("last_order"),
    )
    late = F.col("last_order") < F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00'")
    return (
        table(spark, folder, "customer").select(F.col("c_custkey").alias("member_id"))
        .join(spans, "member_id", "left")
        .select(
            "member_id", "signup_date",
            F.coalesce(late, F.lit(True)).cast("int").alias("churn"),
            ((F.col("member_id") * 7919 + 13) % 10 < 4).cast("int").alias("outreach"),
        )
    )


def app_usage(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events").filter(F.col("event_type").isin("view", "click"))
        .select(F.col("user_id").alias("member_id"), F.lit("session").alias("event_type"),
                F.col("ts").alias("timestamp"))
    )


def web_visits(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    total = pages.agg(F.count("*").alias("n_pages"))
    visits = (
        table(spark, folder, "events").filter(F.col("event_type").isin("view", "click", "signup"))
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("page_id", F.col("event_id") % F.col("n_pages"))
    )
    return visits.join(by_rows(pages), "page_id").select(
        F.col("user_id").alias("member_id"), "url", F.col("ts").alias("timestamp"))


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Dealt into as many tasks as there are rows for: distinct counts hold several rows for each claim of a task, and tasks cut by
    compressed bytes would have millions."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("member_id"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(lines.count() / TASK_LINES))
    return (
        lines.join(by_rows(parts), F.col("l_partkey") == F.col("p_partkey"))
        .join(by_rows(orders), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("member_id", F.col("p_brand").alias("icd_code"), F.col("p_type").alias("icd_group"),
                F.col("l_shipdate").alias("diagnosis_date"))
        .repartition(tasks, "member_id", "icd_code", "diagnosis_date")
    )


def member_tables(spark: SparkSession, folder: str) -> MemberTables:
    return MemberTables(
        app_usage(spark, folder), web_visits(spark, folder), claims(spark, folder), members(spark, folder))
