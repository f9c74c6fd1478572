"""Score summaries, histograms, percentile tables and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from swayline.config import CurveConfig
from swayline.functions.columns import clean
from swayline.operators.curves import ScoreColumns, qini_auc
from swayline.operators.effects import describe
from swayline.operators.running import exact_percentiles, join_same


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def score_summary(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., min, max, range, mean, std) with the population standard deviation."""
    x = clean(F.col(score))
    return df.groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"), (F.max(x) - F.min(x)).alias("range"),
                               F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))


def propensity_by_arm(df: DataFrame, propensity: str = "propensity_score", treatment: str = "treatment") -> DataFrame:
    """One ``describe`` row per arm plus the treated-minus-control difference of means."""
    p = F.col(propensity)
    gap = df.agg((F.avg(F.when(F.col(treatment) == 1, p)) - F.avg(F.when(F.col(treatment) == 0, p))).alias("mean_gap"))
    return describe(df, [propensity], [treatment]).crossJoin(F.broadcast(gap))


def histogram(df: DataFrame, score: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """(by.., bin, lower, upper, count): equal widths over each group's own range, last bin closed.

    A group with a single value gets a range one wide around it. Empty bins have no row.
    """
    x = clean(F.col(score))
    ends = df.groupBy(*by).agg(F.min(x).alias("lo"), F.max(x).alias("hi")).withColumns({
        "lo": F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")),
    })
    lower_edge = lambda i: F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    rows = df.select(*by, x.alias("x")).filter(F.col("x").isNotNull())
    placed = join_same(rows, ends, by) if by else rows.crossJoin(F.broadcast(ends))
    guess = F.floor((F.col("x") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo")))
    placed = placed.withColumn("bin", F.greatest(F.lit(0), F.least(guess, F.lit(bins - 1))))
    # The division can land one bin off at an edge; the edges themselves decide.
    b = F.col("bin")
    placed = placed.withColumn("bin", F.when(F.col("x") < lower_edge(b), b - 1).when(
        (b < bins - 1) & (F.col("x") >= lower_edge(b + 1)), b + 1).otherwise(b))
    return placed.groupBy(*by, "bin", "lo", "hi").agg(F.count("*").alias("count")).select(
        *by, "bin", lower_edge(F.col("bin")).alias("lower"), lower_edge(F.col("bin") + 1).alias("upper"), "count")


def percentile_table(df: DataFrame, score: str, percents: Sequence[int] = (10, 25, 50, 75, 90),
                     by: Sequence[str] = ()) -> DataFrame:
    """(by.., percentile, value), linear interpolation."""
    marks = exact_percentiles(df, [score], [(p, 100) for p in percents], by)
    percent = F.element_at(F.array(*[F.lit(p) for p in percents]), F.col("share_no") + 1)
    return marks.select(*by, percent.alias("percentile"), "value")


def overfit_class(gap: Column) -> Column:
    return F.when(gap > 0.01, "significant").when(gap > 0.005, "mild").otherwise("good")


def overfit_check(train: DataFrame, test: DataFrame, cols: ScoreColumns = ScoreColumns(), *, model: str = "Model",
                  cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """One row (model, qini_train, qini_test, gap, relative_pct, verdict); both splits in one curve job."""
    names = [cols.member, cols.outcome, cols.treatment, cols.score]
    both = train.select(F.lit("train").alias("split"), *names).unionByName(test.select(F.lit("test").alias("split"), *names))
    per_split = qini_auc(both, cols, keys=["split"], cfg=cfg)
    return gap_report(per_split, []).select(F.lit(model).alias("model"), "*")


def gap_report(per_split: DataFrame, keys: Sequence[str], held_out: str = "test") -> DataFrame:
    """Pair the train and held-out Qini area of each key."""
    q = F.col("qini_auc")
    paired = per_split.groupBy(*keys).agg(
        F.max(F.when(F.col("split") == "train", q)).alias("qini_train"),
        F.max(F.when(F.col("split") == held_out, q)).alias("qini_test"))
    gap = F.col("qini_train") - F.col("qini_test")
    return paired.select(*keys, "qini_train", "qini_test", gap.alias("gap"),
                         (F.try_divide(gap, F.col("qini_train")) * 100).alias("relative_pct"),
                         overfit_class(gap).alias("verdict"))


def model_comparison(scores: DataFrame, cols: ScoreColumns = ScoreColumns(), *,
                     cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """(model, qini_auc, min, max, range, mean, std) of long scores ``(model, member, outcome, treatment, uplift)``."""
    areas = qini_auc(scores, cols, keys=["model"], cfg=cfg).drop("n")
    return areas.join(score_summary(scores, cols.score, ["model"]), "model")


def top_trials(trials: DataFrame, by: str = "val_qini", k: int = 10) -> DataFrame:
    """Best ``k`` trials: highest validation area, or lowest gap."""
    order = F.col(by).asc_nulls_last() if by == "overfitting_gap" else F.col(by).desc_nulls_last()
    return trials.orderBy(order, "trial").limit(k)


def parameter_importance(trials: DataFrame, parameters: Sequence[str], metric: str = "val_qini") -> DataFrame:
    """(parameter, corr, abs_corr) with the validation area; null for a parameter that never varied."""
    def guarded(c: str) -> Column:
        x, m = F.col(c).cast("double"), F.col(metric)
        r = F.try_divide(F.covar_samp(x, m), F.stddev_samp(x) * F.stddev_samp(m))
        return F.when((F.min(x) < F.max(x)) & (F.min(m) < F.max(m)), r).alias(c)

    row = trials.agg(*[guarded(c) for c in parameters])
    return row.unpivot([], list(parameters), "parameter", "corr").withColumn("abs_corr", F.abs("corr"))


def improvement(baseline: Column, tuned: Column) -> dict[str, Column]:
    gain = tuned - baseline
    pct = F.when(baseline != 0, 100 * gain / F.abs(baseline)).otherwise(0.0)
    return {"improvement": gain, "pct_improvement": pct}
