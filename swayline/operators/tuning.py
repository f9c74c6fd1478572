"""Random search over learner parameters: trials, selection rule and refit."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from swayline.config import SEARCH_SPACE, BoostConfig, CurveConfig
from swayline.operators.curves import ScoreColumns, qini_auc
from swayline.operators.learners import T_COL, Y_COL, TwoModels, fit_t_learner
from swayline.operators.splits import draw_parameters, stratified_hold_out
from swayline.operators.trees import BOOST_ROWS, feature_array, fit_boosted, gathered
from swayline.sources.storage import materialise


@dataclass(frozen=True)
class Choice:
    trial: int
    val_qini: float
    gap: float


def boost_of(params: dict, seed: int = 42) -> BoostConfig:
    """Search parameters as settings of the boosted trees; every one of them acts. What a space leaves out has its neutral value.

    ``bagging_fraction`` acts when ``bagging_freq`` is drawn above 0. ``subsample`` is drawn for every tree, beside any bag.
    """
    return BoostConfig(
        max_iter=params["n_estimators"], max_depth=params["max_depth"], step_size=params["learning_rate"],
        min_instances=params["min_child_samples"], subsampling=params["bagging_fraction"] if params["bagging_freq"] else 1.0,
        feature_share=params["colsample_bytree"], seed=seed, num_leaves=params.get("num_leaves", 31),
        l1=params.get("reg_alpha", 0.0), l2=params.get("reg_lambda", 0.0), min_split_gain=params.get("min_split_gain", 0.0),
        min_child_weight=params.get("min_child_weight", 1e-3), bagging_freq=params["bagging_freq"], tree_share=params.get("subsample", 1.0))


def select_trial(trials: Sequence[tuple[int, float, float]]) -> Choice | None:
    """Fold ``(trial, val_qini, gap)`` in trial order.

    A trial wins with a better validation area unless its gap grows by 0.01 or more, or with nearly the same area
    (within 0.005) and a smaller gap.
    """
    best = Choice(0, -math.inf, math.inf)
    for trial, val, gap in sorted(trials):
        if val > best.val_qini:
            wins = gap < best.gap + 0.01
        else:
            wins = abs(val - best.val_qini) < 0.005 and gap < best.gap
        if wins:
            best = Choice(trial, val, gap)
    return best if best.trial else None


def trial_table(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """One row per trial: number, areas, gap, parameters."""
    kinds = {int: T.LongType(), float: T.DoubleType()}
    schema = T.StructType([T.StructField(k, kinds[type(v)]) for k, v in rows[0].items()])
    return spark.createDataFrame([Row(**r) for r in rows], schema)


def search(train: DataFrame, features: Sequence[str], trials: int = 20, seed: int = 42, *, space: dict[str, Sequence] = SEARCH_SPACE,
           cols: ScoreColumns = ScoreColumns(), cfg: CurveConfig = CurveConfig(), task_rows: int = BOOST_ROWS) -> list[dict]:
    """Fit ``trials`` random parameter sets on four fifths of every arm and rate them on both parts.

    The models of all trials are fitted side by side, one pass scores every row with all of them, and one aggregate gives the two areas of
    each trial: the driver sees the trees and a row per trial and part. The parts have exactly their share of each arm.
    """
    data = materialise(train, "search")
    fit_part, val_part = (materialise(p, "part") for p in stratified_hold_out(data, cols.treatment, f"{seed}:search", member=cols.member))
    drawn = draw_parameters(space, trials, seed)
    settings = {(i, arm): boost_of(p, seed + 1 - arm) for i, p in enumerate(drawn, 1) for arm in (1, 0)}
    fitted = fit_boosted(fit_part, features, Y_COL, {f"{i}:{arm}": (arm, c) for (i, arm), c in settings.items()}, T_COL, cols.member, task_rows)
    shared, width = train.sparkSession.sparkContext.broadcast(fitted), len(features)
    both = fit_part.withColumn("split", F.lit("train")).unionByName(val_part.withColumn("split", F.lit("val"))).select(
        "split", cols.member, cols.outcome, cols.treatment, feature_array(features).alias("x"))

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            rows = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            found = np.stack([shared.value[f"{i}:1"].predict(rows) - shared.value[f"{i}:0"].predict(rows) for i in range(1, trials + 1)], axis=1)
            scores = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * trials), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], scores], [*batch.schema.names[:4], "scores"])

    kind = T.StructType([*both.schema.fields[:4], T.StructField("scores", T.ArrayType(T.DoubleType()))])
    scored = both.mapInArrow(rated, kind).select("split", cols.member, cols.outcome, cols.treatment, F.posexplode("scores").alias("trial", cols.score))
    areas = qini_auc(materialise(scored, "trials"), cols, keys=["trial", "split"], cfg=cfg).collect()
    found = {(r["trial"] + 1, r["split"]): float("nan") if r["qini_auc"] is None else r["qini_auc"] for r in areas}
    rows = []
    for i, params in enumerate(drawn, 1):
        tr, val = (found.get((i, s), float("nan")) for s in ("train", "val"))
        rows.append({"trial": i, "train_qini": tr, "val_qini": val, "overfitting_gap": tr - val, **params})
    return rows


def refit_best(train: DataFrame, features: Sequence[str], rows: Sequence[dict], seed: int = 42) -> TwoModels:
    """Fit the selected trial's parameters on the whole training table."""
    choice = select_trial([(r["trial"], r["val_qini"], r["overfitting_gap"]) for r in rows])
    if choice is None:
        raise ValueError("no trial qualifies")
    params = next(r for r in rows if r["trial"] == choice.trial)
    return fit_t_learner(train, features, boost_of(params, seed))
