"""Schema, null and drift checks between a train and a test split. Every result is one row per column or category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from swayline.config import DriftConfig
from swayline.functions.columns import lenient_timestamp, rate
from swayline.operators.running import cells, name_of

LABELS = ("churn", "outreach", "treatment", "y", "member_id")


def numeric_columns(df: DataFrame, skip: Sequence[str] = ("member_id",)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def shared_columns(train: DataFrame, test: DataFrame) -> list[str]:
    return [c for c in train.columns if c in set(test.columns)]


def schema_consistency(train: DataFrame, test: DataFrame) -> DataFrame:
    """(column, in_train, in_test, pos_train, pos_test, order_ok); positions count from 0.

    ``order_ok`` compares the column's place among the shared columns of both splits.
    """
    shared_train = shared_columns(train, test)
    shared_test = shared_columns(test, train)
    rows = []
    for name in dict.fromkeys([*train.columns, *test.columns]):
        both = name in shared_train
        rows.append((
            name, name in train.columns, name in test.columns,
            train.columns.index(name) if name in train.columns else None,
            test.columns.index(name) if name in test.columns else None,
            shared_train.index(name) == shared_test.index(name) if both else None,
        ))
    schema = "column string, in_train boolean, in_test boolean, pos_train int, pos_test int, order_ok boolean"
    return train.sparkSession.createDataFrame(rows, schema)


def _null_counts(df: DataFrame, split: str) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls").select(F.lit(split).alias("split"), "column", "nulls")


def null_audit(train: DataFrame, test: DataFrame) -> DataFrame:
    """(split, column, nulls) for every column that has any."""
    both = _null_counts(train, "train").unionByName(_null_counts(test, "test"))
    return both.filter(F.col("nulls") > 0)


def unread_times(raw: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """(column, present, unread): how many texts there are, and how many of them no format reads and so become null."""
    text = F.col(column)
    unread = text.isNotNull() & lenient_timestamp(text, formats).isNull()
    return raw.agg(F.lit(column).alias("column"), F.count(text).alias("present"), F.count_if(unread).alias("unread"))


def tagged(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both splits under one plan, told apart by ``is_test``."""
    return train.select(F.lit(False).alias("is_test"), *columns).unionByName(
        test.select(F.lit(True).alias("is_test"), *columns))


def numeric_drift(train: DataFrame, test: DataFrame, columns: Sequence[str],
                  cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """(feature, mean_train, mean_test, mean_shift, std_train, drifted) from one pass over both splits."""
    rows = cells(tagged(train, test, columns), columns, ["is_test"]).groupBy("pos", "is_test").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")).withColumn("feature", name_of(columns))
    in_test = F.col("is_test")
    arms = rows.groupBy("feature").agg(
        F.max(F.when(~in_test, F.col("mean"))).alias("mean_train"),
        F.max(F.when(in_test, F.col("mean"))).alias("mean_test"),
        F.max(F.when(~in_test, F.col("std"))).alias("std_train"))
    shift = F.col("mean_test") - F.col("mean_train")
    return arms.select("feature", "mean_train", "mean_test", shift.alias("mean_shift"), "std_train",
                       F.coalesce(F.abs(shift) > F.col("std_train") * cfg.std_share, F.lit(False)).alias("drifted"))


def frequency_table(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n_train, n_test, freq_train, freq_test); a category of one split counts 0 in the other."""
    both = tagged(train, test, columns)
    in_test = F.col("is_test")
    counts = (
        both.unpivot(["is_test"], list(columns), "feature", "category").filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count_if(~in_test).alias("n_train"), F.count_if(in_test).alias("n_test"))
    )
    # Sums of the counts, whose exchange both sides share: one row per column, and its categories never meet in one task.
    totals = counts.groupBy("feature").agg(F.sum("n_train").alias("all_train"), F.sum("n_test").alias("all_test"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "category", "n_train", "n_test",
        F.coalesce(rate(F.col("n_train"), F.col("all_train")), F.lit(0.0)).alias("freq_train"),
        F.coalesce(rate(F.col("n_test"), F.col("all_test")), F.lit(0.0)).alias("freq_test"))


def categorical_drift(train: DataFrame, test: DataFrame, columns: Sequence[str],
                      cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """(feature, max_freq_diff, drifted)."""
    gap = F.max(F.abs(F.col("freq_train") - F.col("freq_test")))
    return frequency_table(train, test, columns).groupBy("feature").agg(gap.alias("max_freq_diff")).withColumn(
        "drifted", F.col("max_freq_diff") > cfg.frequency_gap)


def health_check(train: DataFrame, test: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """One long report (check, column, metric, value) of schema, nulls and drift over the shared columns; labels do not drift."""
    shared = shared_columns(train, test)
    report = schema_consistency(train, test).select(F.lit("schema").alias("check"), "column", F.explode(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
          for m in ("in_train", "in_test", "order_ok")])).alias("m")).select("check", "column", "m.*")
    nulls = null_audit(train, test).select(
        F.lit("nulls").alias("check"), "column", F.col("split").alias("metric"), F.col("nulls").cast("double").alias("value"))
    report = report.unionByName(nulls)
    numbers = [c for c in numeric_columns(train, LABELS) if c in shared]
    texts = [c for c in text_columns(train) if c in shared]
    if numbers:
        drift = numeric_drift(train, test, numbers, cfg)
        report = report.unionByName(_drift_rows(drift, "numeric drift", "mean_shift"))
    if texts:
        drift = categorical_drift(train, test, texts, cfg)
        report = report.unionByName(_drift_rows(drift, "categorical drift", "max_freq_diff"))
    return report


def _drift_rows(drift: DataFrame, check: str, metric: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in (metric, "drifted")])
    return drift.select(F.lit(check).alias("check"), F.col("feature").alias("column"), F.explode(pairs).alias("m")).select(
        "check", "column", "m.*")
