"""Ranking, Qini curves, AUUC, target size and ranking metrics.

A score table holds one row per (model and) member: ``member_id, y, treatment, uplift``. Treatment and outcome
are 0/1. Curves have one point per member, so they are running sums, never a re-count of each prefix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from swayline.config import CurveConfig
from swayline.functions.columns import clean, rate
from swayline.operators.running import Cuts, find_cuts, running_sums


@dataclass(frozen=True)
class ScoreColumns:
    score: str = "uplift"
    outcome: str = "y"
    treatment: str = "treatment"
    member: str = "member_id"


def score_cuts(df: DataFrame, cols: ScoreColumns = ScoreColumns(), cfg: CurveConfig = CurveConfig()) -> Cuts:
    """Bucket thresholds of a score table, to share between several curves over it."""
    ready = df.withColumn(cols.score, clean(F.col(cols.score)))
    return find_cuts(ready, cols.score, cols.member, (), cfg)


def rank_members(df: DataFrame, score: str = "uplift", *, descending: bool = True, member: str = "member_id",
                 first: int | None = None, cuts: Cuts | None = None, cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """Unique rank 1..N by score, ties by member. With ``first``, only that many rows, and only their buckets are sorted."""
    ranked = running_sums(df, score, {"rank": F.lit(1).cast("bigint")}, tie_break=member, descending=descending,
                          first=first, cuts=cuts, cfg=cfg).drop("before_rank")
    return ranked


def counted(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True, first: int | None = None,
            cuts: Cuts | None = None, cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """Running k, n_treated, n_control, y_treated, y_control and sum_score in score order."""
    t, y = F.col(cols.treatment).cast("bigint"), F.col(cols.outcome).cast("bigint")
    needed = df.select(cols.member, cols.outcome, cols.treatment, cols.score)
    return running_sums(needed, cols.score, {
        "k": F.lit(1).cast("bigint"),
        "n_treated": t, "n_control": 1 - t, "y_treated": y * t, "y_control": y * (1 - t),
        "sum_score": F.coalesce(F.col(cols.score), F.lit(0.0)),
    }, tie_break=cols.member, descending=descending, first=first, cuts=cuts, cfg=cfg)


def scaled_control(nc: Column, yc: Column, nt: Column) -> Column:
    """Control outcomes scaled to the size of the treated group; null without controls."""
    return F.try_divide(yc.cast("double") * nt, nc.cast("double"))


def gain_prevented() -> Column:
    """Outcomes prevented among the treated: scaled control minus treated; 0 while an arm is empty."""
    both = (F.col("n_treated") > 0) & (F.col("n_control") > 0)
    return F.when(both, scaled_control(F.col("n_control"), F.col("y_control"), F.col("n_treated")) - F.col("y_treated")).otherwise(0.0)


def gain_added() -> Column:
    """Outcomes added among the treated: treated minus scaled control; the treated count alone without controls."""
    scaled = F.coalesce(scaled_control(F.col("n_control"), F.col("y_control"), F.col("n_treated")), F.lit(0.0))
    return F.col("y_treated") - scaled


def gain_floored() -> Column:
    """Cumulative-sum form of ``gain_added``: the control count is floored at one."""
    return F.col("y_treated") - F.col("y_control") * (F.col("n_treated") / F.greatest(F.col("n_control"), F.lit(1)).cast("double"))


def qini_gain_curve(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True,
                    first: int | None = None, cuts: Cuts | None = None,
                    cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """(k, qini_gain, avg_uplift, pct_targeted) with ``gain_added``: the curve the target size is read from."""
    total = df.agg(F.count("*").alias("n"))
    points = counted(df, cols, descending=descending, first=first, cuts=cuts, cfg=cfg)
    return points.crossJoin(F.broadcast(total)).select(
        cols.member, "k", gain_added().alias("qini_gain"),
        (F.col("sum_score") / F.col("k")).alias("avg_uplift"),
        (F.col("k") * 100.0 / F.col("n")).alias("pct_targeted"),
    )


def qini_cumulative_curve(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True,
                          cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """(k, qini) in the cumulative-sum form."""
    return counted(df, cols, descending=descending, cfg=cfg).select(cols.member, "k", gain_floored().alias("qini"))


def arm_totals(df: DataFrame, cols: ScoreColumns = ScoreColumns(), keys: Sequence[str] = ()) -> DataFrame:
    """Whole-table counts per key: n_all, nt_all, nc_all, yt_all, yc_all."""
    t, y = F.col(cols.treatment).cast("bigint"), F.col(cols.outcome).cast("bigint")
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_all"), F.sum(t).alias("nt_all"), F.sum(1 - t).alias("nc_all"),
        F.sum(y * t).alias("yt_all"), F.sum(y * (1 - t)).alias("yc_all"))


def total_prevented() -> Column:
    """Gain of treating everyone, from ``arm_totals``; null when an arm is empty."""
    treated = rate(F.col("yt_all"), F.col("nt_all"))
    return (rate(F.col("yc_all"), F.col("nc_all")) - treated) * F.col("nt_all")


def prevented_curve(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True,
                    cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """(k, qini_gain, random_gain): prevented outcomes against the straight line of random targeting."""
    return counted(df, cols, descending=descending, cfg=cfg).crossJoin(F.broadcast(arm_totals(df, cols))).select(
        cols.member, "k", gain_prevented().alias("qini_gain"),
        (F.col("k") / F.col("n_all") * total_prevented()).alias("random_gain"),
    )


def auuc(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True,
         cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """One row (auuc, total_gain, n). Points are one apart, so the trapezoid is a sum less half of both ends."""
    curve = counted(df, cols, descending=descending, cfg=cfg).crossJoin(F.broadcast(arm_totals(df, cols)))
    gap = gain_prevented() - F.col("k") / F.col("n_all") * total_prevented()
    end = (F.col("k") == 1).cast("int") + (F.col("k") == F.col("n_all")).cast("int")
    return curve.select("n_all", total_prevented().alias("total"), (gap * (1 - end / 2.0)).alias("part")).agg(
        (F.sum("part") / F.max("n_all")).alias("auuc"), F.max("total").alias("total_gain"), F.max("n_all").alias("n"))


def optimal_target(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, descending: bool = True,
                   max_budget_n: int | None = None, cuts: Cuts | None = None,
                   cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """One row: the k of largest gain (the smallest such k), its gain, mean score and share of members."""
    curve = qini_gain_curve(df, cols, descending=descending, first=max_budget_n, cuts=cuts, cfg=cfg).drop(cols.member)
    if max_budget_n is not None:
        curve = curve.filter(F.col("k") <= max_budget_n)
    best = F.max(F.struct("qini_gain", (-F.col("k")).alias("neg_k"), "avg_uplift", "pct_targeted")).alias("best")
    return curve.agg(best).filter("best is not null").select(
        (-F.col("best.neg_k")).alias("optimal_n"), F.col("best.qini_gain").alias("max_qini_gain"),
        F.col("best.avg_uplift").alias("avg_uplift"), F.col("best.pct_targeted").alias("pct_targeted"))


def qini_auc(df: DataFrame, cols: ScoreColumns = ScoreColumns(), *, keys: Sequence[str] = (),
             cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """Normalised Qini area per key: (model area - diagonal) / (perfect area - diagonal).

    One point per distinct score, controls scaled by NT/NC (0 without controls). The perfect ranking has three
    tie groups (treated with outcome, no outcome, control with outcome), so its area needs totals only.
    """
    t, y = F.col(cols.treatment).cast("bigint"), F.col(cols.outcome).cast("bigint")
    named = df.select(*keys, F.col(cols.score).alias("_s"), cols.treatment, cols.outcome)
    points = running_sums(named, "_s", {"n": F.lit(1).cast("bigint"), "nt": t, "yt": y * t, "yc": y * (1 - t)},
                          tie_break=None, keys=keys, cfg=cfg)

    def height(prefix: str) -> Column:
        nt, nc = F.col(f"{prefix}nt"), F.col(f"{prefix}n") - F.col(f"{prefix}nt")
        ratio = F.coalesce(F.try_divide(nt.cast("double"), nc.cast("double")), F.lit(0.0))
        return F.col(f"{prefix}yt") - F.col(f"{prefix}yc") * ratio

    strip = (F.col("n") - F.col("before_n")) * (height("") + height("before_")) / 2.0
    area = points.groupBy(*keys).agg(
        F.sum(strip).alias("model_area"), F.max("n").alias("n_all"), F.max("nt").alias("nt_all"),
        F.max("yt").alias("yt_all"), F.max("yc").alias("yc_all"))
    ratio = F.coalesce(F.try_divide(F.col("nt_all").cast("double"), (F.col("n_all") - F.col("nt_all")).cast("double")),
                       F.lit(0.0))
    last = F.col("yt_all") - F.col("yc_all") * ratio
    diagonal = F.col("n_all") * last / 2.0
    quiet = F.col("n_all") - F.col("yt_all") - F.col("yc_all")
    perfect = (F.col("yt_all") * F.col("yt_all") / 2.0 + quiet * F.col("yt_all")
               + F.col("yc_all") * (F.col("yt_all") + last) / 2.0)
    return area.select(*keys, F.try_divide(F.col("model_area") - diagonal, perfect - diagonal).alias("qini_auc"),
                       F.col("n_all").alias("n"))


def roc_auc(df: DataFrame, score: str, label: str, *, keys: Sequence[str] = (),
            cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """Rank-sum ROC area per key: a tie counts one half. Null when a class is absent."""
    positive = F.col("_label").cast("bigint")
    named = df.select(*keys, F.col(score).alias("_s"), F.col(label).alias("_label"))
    points = running_sums(named, "_s", {"pos": positive, "neg": 1 - positive}, tie_break=None, keys=keys,
                          descending=False, cfg=cfg)
    won = (F.col("pos") - F.col("before_pos")) * (F.col("neg") + F.col("before_neg")) / 2.0
    return points.groupBy(*keys).agg(
        F.try_divide(F.sum(won), F.max("pos").cast("double") * F.max("neg")).alias("roc_auc"))


def classification_report(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages, from four counts. A missing score is a
    guess of class 0, so its row stays in the support; rows without a label are in no class."""
    guess, truth = F.coalesce(clean(F.col(score)) >= threshold, F.lit(False)).cast("int"), F.col(label).cast("int")
    cells = df.select(guess.alias("g"), truth.alias("t")).agg(*[
        F.count_if((F.col("g") == g) & (F.col("t") == t)).alias(f"c{g}{t}") for g in (0, 1) for t in (0, 1)])
    per_class = cells.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("cls")).select(
        F.col("cls").cast("string").alias("label"),
        F.when(F.col("cls") == 1, F.col("c11")).otherwise(F.col("c00")).alias("hit"),
        F.when(F.col("cls") == 1, F.col("c10") + F.col("c11")).otherwise(F.col("c00") + F.col("c01")).alias("guessed"),
        F.when(F.col("cls") == 1, F.col("c01") + F.col("c11")).otherwise(F.col("c00") + F.col("c10")).alias("support"),
    )

    def or_zero(a: Column, b: Column) -> Column:
        return F.coalesce(rate(a, b), F.lit(0.0))

    scored = per_class.withColumns({
        "precision": or_zero(F.col("hit"), F.col("guessed")), "recall": or_zero(F.col("hit"), F.col("support")),
        "f1": or_zero(2 * F.col("hit"), F.col("guessed") + F.col("support")),
    })
    measures = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    macro = scored.agg(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], total)
    weighted = scored.agg(F.lit("weighted avg").alias("label"), *[
        rate(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures], total)
    hit_rate = rate(F.sum("hit"), F.sum("support"))
    accuracy = scored.agg(F.lit("accuracy").alias("label"), *[hit_rate.alias(m) for m in measures], total)
    columns = ["label", *measures, "support"]
    return scored.select(columns).unionByName(accuracy).unionByName(macro).unionByName(weighted)


def worth_targeting(df: DataFrame, value_per_outcome: float, cost: float, score: str = "uplift", *,
                    outcome_is_bad: bool = True, member: str = "member_id",
                    cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """Members whose expected benefit covers the cost, best first. With a bad outcome, benefit is minus uplift."""
    sign = -1.0 if outcome_is_bad else 1.0
    chosen = df.withColumn("benefit", F.col(score) * sign).filter(F.col("benefit") * value_per_outcome >= cost)
    return rank_members(chosen, "benefit", member=member, cfg=cfg)
