"""Treatment-control comparisons: per arm, per feature and per segment."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from swayline.config import PRIORITY_KEYWORDS, safe_name
from swayline.functions.columns import rate
from swayline.functions.tdist import two_sided_p
from swayline.operators.running import cells, exact_percentiles, join_same, name_of, number_of

QUARTILES = ((1, 4), (1, 2), (3, 4))
TERTILE_EDGES = ((0, 1), (1, 3), (2, 3), (1, 1))


def arm(df: DataFrame, treated: int, treatment: str = "treatment") -> DataFrame:
    return df.filter(F.col(treatment) == treated)


def arm_means(df: DataFrame, features: Sequence[str], treatment: str = "treatment") -> DataFrame:
    """One row per arm, one mean per feature."""
    return df.groupBy(treatment).agg(*[F.avg(c).alias(c) for c in features])


def arm_moments(df: DataFrame, features: Sequence[str], treatment: str = "treatment") -> DataFrame:
    """(feature, n, mean and variance of both arms)."""
    x = F.col("value")
    rows = cells(df, features, [treatment]).groupBy("pos", treatment).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"))
    picks = [F.max(F.when(F.col(treatment) == t, F.col(m))).alias(f"{m}_{name}")
             for t, name in ((0, "control"), (1, "treated")) for m in ("n", "mean", "var")]
    return rows.groupBy(name_of(features).alias("feature")).agg(*picks)


def arm_differences(df: DataFrame, features: Sequence[str], treatment: str = "treatment") -> DataFrame:
    """(feature, difference, control_mean, treated_mean, abs_difference), treated minus control."""
    gap = F.col("mean_treated") - F.col("mean_control")
    return arm_moments(df, features, treatment).select(
        "feature", gap.alias("difference"), F.col("mean_control").alias("control_mean"),
        F.col("mean_treated").alias("treated_mean"), F.abs(gap).alias("abs_difference"))


def top_differences(df: DataFrame, features: Sequence[str], k: int = 20, treatment: str = "treatment") -> DataFrame:
    return arm_differences(df, features, treatment).orderBy(
        F.col("abs_difference").desc_nulls_last(), "feature").limit(k)


def describe(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., feature, count, mean, std, min, p25, p50, p75, max) with exact quartiles. Needs a feature or more."""
    x = F.col("value")
    rows = cells(df, features, by).groupBy(*by, "pos").agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max")).withColumn("feature", name_of(features))
    marks = exact_percentiles(df, features, QUARTILES, by).groupBy(*by, "feature").agg(*[
        F.max(F.when(F.col("share_no") == i, F.col("value"))).alias(name)
        for i, name in enumerate(("p25", "p50", "p75"))])
    return join_same(rows, marks, [*by, "feature"], "left").select(
        *by, "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def welch_test(df: DataFrame, features: Sequence[str], k: int = 20, treatment: str = "treatment") -> DataFrame:
    """Unequal-variance t-test of the ``k`` features whose arm means differ most."""
    m = arm_moments(df, features, treatment)
    gap = F.col("mean_treated") - F.col("mean_control")
    top = m.withColumn("difference", gap).orderBy(F.abs("difference").desc_nulls_last(), "feature").limit(k)
    share_t = F.try_divide(F.col("var_treated"), F.col("n_treated").cast("double"))
    share_c = F.try_divide(F.col("var_control"), F.col("n_control").cast("double"))
    spread = share_t + share_c
    df_bottom = (F.try_divide(share_t * share_t, (F.col("n_treated") - 1).cast("double"))
                 + F.try_divide(share_c * share_c, (F.col("n_control") - 1).cast("double")))
    tested = top.select("feature", "difference", F.try_divide(F.col("difference"), F.sqrt(spread)).alias("t_stat"),
                        F.try_divide(spread * spread, df_bottom).alias("dof"))

    @F.pandas_udf(T.DoubleType())
    def p_of(t: pd.Series, dof: pd.Series) -> pd.Series:  # at most k rows ever reach it
        return pd.Series([None if pd.isna(a) or pd.isna(b) else two_sided_p(a, b) for a, b in zip(t, dof)],
                         dtype="float64")

    return tested.withColumn("p_value", p_of("t_stat", "dof")).withColumn(
        "significant", F.coalesce(F.col("p_value") < 0.05, F.lit(False)))


def priority_columns(columns: Sequence[str], keywords: Sequence[str] = PRIORITY_KEYWORDS) -> list[str]:
    """Columns whose lower-cased name contains a keyword; keywords are cleaned like generated column names."""
    wanted = [safe_name(k).lower() for k in keywords]
    return [c for c in columns if any(k in c.lower() for k in wanted)]


def priority_comparison(df: DataFrame, features: Sequence[str], keywords: Sequence[str] = PRIORITY_KEYWORDS,
                        treatment: str = "treatment") -> DataFrame:
    """(feature, control_mean, treated_mean, difference) of the priority columns; empty when there are none."""
    picked = priority_columns(features, keywords)
    if not picked:
        schema = "feature string, control_mean double, treated_mean double, difference double"
        return df.sparkSession.createDataFrame([], schema)
    return arm_differences(df, picked, treatment).select("feature", "control_mean", "treated_mean", "difference")


def average_effect(df: DataFrame, outcome: str = "y", treatment: str = "treatment") -> DataFrame:
    """One row (ate, treated_rate, control_rate)."""
    y = F.col(outcome).cast("double")
    treated, control = F.avg(F.when(F.col(treatment) == 1, y)), F.avg(F.when(F.col(treatment) == 0, y))
    return df.agg((treated - control).alias("ate"), treated.alias("treated_rate"), control.alias("control_rate"))


def distinct_gate(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n_distinct, kind): 'constant' up to one value, 'categorical' up to three, else 'numeric'. Counts are exact."""
    values = cells(df, features).groupBy("pos", "value").agg(F.lit(1).alias("one"))
    counts = values.groupBy(name_of(features).alias("feature")).agg(F.count("value").alias("n_distinct"))
    n = F.col("n_distinct")
    kind = F.when(n <= 1, "constant").when(n <= 3, "categorical").otherwise("numeric")
    return counts.withColumn("kind", kind)


def tertile_edges(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, lowest, edge_1, edge_2, highest, status); status 'skipped_ties' when two edges coincide."""
    marks = exact_percentiles(df, features, TERTILE_EDGES).groupBy("feature").agg(*[
        F.max(F.when(F.col("share_no") == i, F.col("value"))).alias(name)
        for i, name in enumerate(("lowest", "edge_1", "edge_2", "highest"))])
    distinct_edges = ((F.col("lowest") < F.col("edge_1")) & (F.col("edge_1") < F.col("edge_2"))
                      & (F.col("edge_2") < F.col("highest")))
    return marks.withColumn("status", F.when(distinct_edges, "ok").otherwise("skipped_ties"))


def segment_plan(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, kind, n_distinct, edge_1, edge_2, status): how each feature is cut into segments. One row per feature."""
    gate = distinct_gate(df, features)
    edges = tertile_edges(df, features).select("feature", "edge_1", "edge_2", "status")
    status = (F.when(F.col("kind") == "constant", "skipped_constant").when(F.col("kind") == "categorical", "ok")
              .otherwise(F.coalesce(F.col("status"), F.lit("skipped_ties"))))
    return gate.join(edges, "feature", "left").select("feature", "kind", "n_distinct", "edge_1", "edge_2", status.alias("status"))


def segment_effects(df: DataFrame, features: Sequence[str], outcome: str = "y",
                    treatment: str = "treatment") -> DataFrame:
    """(feature, segment, ate, members, n_treated, n_control, treated_rate, control_rate) for every feature at once.

    Every cell meets the cut of its feature (one row per feature) and combines on the map side to a few segments per
    feature, so the shuffle is tiny whatever the table size. Segments without both arms are left out.
    """
    plan = segment_plan(df, features).filter(F.col("status") == "ok").select(
        number_of(features).alias("pos"), "kind", "edge_1", "edge_2")
    value, t, y = F.col("value"), F.col(treatment).cast("bigint"), F.col(outcome).cast("bigint")
    level = F.when(value <= F.col("edge_1"), 0.0).when(value <= F.col("edge_2"), 1.0).otherwise(2.0)
    code = F.when(F.col("kind") == "categorical", value).otherwise(level)
    groups = cells(df, features, [outcome, treatment]).filter(value.isNotNull()).join(
        F.broadcast(plan), "pos").groupBy("pos", "kind", code.alias("code")).agg(
        F.count("*").alias("members"), F.sum(t).alias("n_treated"), F.sum(1 - t).alias("n_control"),
        F.sum(y * t).alias("yt"), F.sum(y * (1 - t)).alias("yc"))
    name = F.element_at(F.array(F.lit("Low"), F.lit("Medium"), F.lit("High")), F.col("code").cast("int") + 1)
    segment = F.when(F.col("kind") == "numeric", name).otherwise(F.col("code").cast("string"))
    treated, control = rate(F.col("yt"), F.col("n_treated")), rate(F.col("yc"), F.col("n_control"))
    return groups.filter((F.col("n_treated") > 0) & (F.col("n_control") > 0)).select(
        name_of(features).alias("feature"), segment.alias("segment"), (treated - control).alias("ate"), "members", "n_treated", "n_control",
        treated.alias("treated_rate"), control.alias("control_rate"))


def segment_extremes(effects: DataFrame, overall: DataFrame) -> DataFrame:
    """Per feature the lowest- and highest-effect segment, and whether each is worth reporting.

    ``effects`` is ``segment_effects``; ``overall`` is ``average_effect``. Ties go to the earlier segment
    (Low, Medium, High, or value order).
    """
    place = F.array_position(F.array(F.lit("Low"), F.lit("Medium"), F.lit("High")), F.col("segment")).alias("place")

    def first_by(key: Column) -> Column:
        return F.min(F.struct(key.alias("key"), place, "segment", "ate", "members"))

    ends = effects.groupBy("feature").agg(first_by(F.col("ate")).alias("lo"), first_by(-F.col("ate")).alias("hi"))
    return ends.crossJoin(F.broadcast(overall.select(F.col("ate").alias("overall_ate")))).select(
        "feature", F.col("lo.segment").alias("best_segment"), F.col("lo.ate").alias("best_ate"),
        F.col("lo.members").alias("best_members"), (F.col("lo.ate") < F.col("overall_ate")).alias("best_reported"),
        F.col("hi.segment").alias("worst_segment"), F.col("hi.ate").alias("worst_ate"),
        F.col("hi.members").alias("worst_members"), (F.col("hi.ate") > 0).alias("worst_reported"))
