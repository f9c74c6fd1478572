"""End-to-end flows: raw tables to features, features to scores, scores to a ranked contact list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from swayline.config import CurveConfig, FeatureConfig
from swayline.operators import curves, effects, features as feature_ops, interactions, selection
from swayline.operators.curves import ScoreColumns
from swayline.sources.storage import materialise
from swayline.sources.tables import MemberTables, write_table


class Scorer(Protocol):
    """A fitted learner."""

    def score(self, df: DataFrame, out: str = "uplift") -> DataFrame: ...


def prepare(tables: MemberTables, cfg: FeatureConfig) -> DataFrame:
    """Feature rows, written once: selection, learners and reports all read them again."""
    return materialise(feature_ops.build_features(tables, cfg), "features")


def select_features(train: DataFrame, threshold: float = 0.8) -> list[str]:
    """Names of the features that survive the redundancy rule."""
    names = feature_ops.feature_names(train)
    matrix = selection.moments(train, [*names, "y", "treatment"])
    corr = selection.correlation_table(train.sparkSession, matrix)
    dropped = set(selection.features_to_drop(corr, names, "y", threshold))
    return [c for c in names if c not in dropped]


def with_interactions(df: DataFrame, chosen: Sequence[str]) -> DataFrame:
    """Both families of interaction columns: chosen candidates and keyword priorities."""
    names = feature_ops.feature_names(df)
    both = interactions.add_interactions(df, chosen)
    return interactions.add_interactions(both, effects.priority_columns(names), prefix=interactions.PRIORITY_PREFIX)


def arm_report(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Write the treated-versus-control comparison of a split and return it."""
    report = effects.arm_differences(df, feature_ops.feature_names(df))
    write_table(report, path, fmt)
    return report


def choose_interactions(train: DataFrame, test: DataFrame, threshold: float = 0.1,
                        limit: int = 15) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both splits with interaction columns, and the features chosen for them on the train split."""
    names = feature_ops.feature_names(train)
    matrix = selection.moments(train, [*names, "y", "treatment"])
    corr = selection.correlation_table(train.sparkSession, matrix)
    found = selection.interaction_candidates(corr, names, threshold=threshold, limit=limit).collect()  # ``limit`` rows
    chosen = [r["feature"] for r in found]
    return with_interactions(train, chosen), with_interactions(test, chosen), chosen


def long_scores(models: Mapping[str, Scorer], df: DataFrame, member: str = "member_id", by: Sequence[str] = ()) -> DataFrame:
    """(model, by.., member, y, treatment, uplift) of several fitted learners, the input of ``reports.model_comparison``."""
    parts = [model.score(df).select(F.lit(name).alias("model"), *by, member, "y", "treatment", "uplift")
             for name, model in models.items()]
    return materialise(reduce(DataFrame.unionByName, parts), "model-scores")


def contact_list(scores: DataFrame, cols: ScoreColumns = ScoreColumns(), *, curve_descending: bool = True,
                 list_descending: bool = False, max_budget_n: int | None = None,
                 cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """(member, prioritization_score, rank, outcome) of the best target size.

    The size is read from the gain curve in one direction and applied to the ranking in another; give both the
    same direction for a consistent list. With a bad outcome, low uplift (fewer bad outcomes) ranks first.
    """
    scored = materialise(scores.select(cols.member, cols.outcome, cols.treatment, cols.score), "scores")
    cuts = curves.score_cuts(scored, cols, cfg)
    best = curves.optimal_target(scored, cols, descending=curve_descending, max_budget_n=max_budget_n, cuts=cuts,
                                 cfg=cfg).first()
    ranked = curves.rank_members(scored, cols.score, descending=list_descending, member=cols.member,
                                 first=best["optimal_n"] if best else 0, cuts=cuts, cfg=cfg)
    return ranked.select(cols.member, F.col(cols.score).alias("prioritization_score"), "rank", cols.outcome)
