"""Feature selection from one correlation matrix: redundant pairs, target correlation, drops, VIF, candidates.

The table is read for the matrix only. What reaches the driver grows with the number of features squared, never
with rows; pair walking and the VIF solve run there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from swayline.functions.columns import clean

NULL_SPACE = 1e-10


@dataclass(frozen=True)
class Moments:
    """Row count, means, standard deviations (n-1) and Pearson matrix of named columns. NaN marks a constant."""

    names: tuple[str, ...]
    n: int
    mean: np.ndarray
    std: np.ndarray
    corr: np.ndarray

    def gram(self, names: Sequence[str]) -> np.ndarray:
        """X'X of the given columns, rebuilt from the moments."""
        at = [self.names.index(c) for c in names]
        r = np.nan_to_num(self.corr[np.ix_(at, at)], nan=0.0)
        np.fill_diagonal(r, 1.0)
        cov = r * np.outer(self.std[at], self.std[at])
        return (self.n - 1) * cov + self.n * np.outer(self.mean[at], self.mean[at])


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Two distributed passes over an assembled vector; nulls count as 0."""
    filled = df.select(*[F.coalesce(clean(F.col(c)), F.lit(0.0)).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(filled).select("v")
    v = F.col("v")
    stats = vectors.select(Summarizer.metrics("count", "mean", "std").summary(v).alias("s")).select("s.*").first()
    corr = Correlation.corr(vectors, "v").first()[0].toArray().copy()
    std = np.array(stats["std"].toArray())
    flat = std == 0.0
    corr[flat, :] = np.nan
    corr[:, flat] = np.nan
    return Moments(tuple(columns), int(stats["count"]), np.array(stats["mean"].toArray()), std, corr)


def _number(x: float) -> float | None:
    return None if math.isnan(x) else float(x)


def correlation_table(spark: SparkSession, m: Moments) -> DataFrame:
    """(feature_1, feature_2, corr), every ordered pair; null where a column is constant."""
    rows = [(a, b, _number(m.corr[i, j])) for i, a in enumerate(m.names) for j, b in enumerate(m.names)]
    return spark.createDataFrame(rows, "feature_1 string, feature_2 string, corr double")


def redundant_pairs(corr: DataFrame, features: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """(feature_1, feature_2, abs_corr) above the threshold, each pair once in ``features`` order, strongest first.

    Labels are not features, so they never enter a pair.
    """
    place = F.create_map(*[x for i, c in enumerate(features) for x in (F.lit(c), F.lit(i))])
    first, second = place[F.col("feature_1")], place[F.col("feature_2")]
    strong = corr.filter((first < second) & (F.abs("corr") > threshold))
    return strong.select("feature_1", "feature_2", F.abs("corr").alias("abs_corr")).orderBy(
        F.col("abs_corr").desc(), "feature_1", "feature_2")


def target_correlation(corr: DataFrame, features: Sequence[str], outcome: str = "y",
                       treatment: str = "treatment") -> DataFrame:
    """(feature, abs_corr_outcome, abs_corr_treatment), strongest outcome correlation first."""
    def against(label: str):
        return F.max(F.when(F.col("feature_2") == label, F.abs("corr")))

    return corr.filter(F.col("feature_1").isin(list(features))).groupBy(F.col("feature_1").alias("feature")).agg(
        against(outcome).alias("abs_corr_outcome"), against(treatment).alias("abs_corr_treatment"),
    ).orderBy(F.col("abs_corr_outcome").desc_nulls_last(), "feature")


def greedy_drops(pairs: Sequence[tuple[str, str, float]], outcome_corr: dict[str, float | None]) -> list[str]:
    """Walk pairs strongest first. Of two features still kept, the one less tied to the outcome goes; the second on a tie.

    Correlations are compared to 12 places, so summation order cannot decide a tie.
    """
    dropped: dict[str, None] = {}
    for first, second, _ in sorted(pairs, key=lambda p: (-round(p[2], 12), p[0], p[1])):
        if first in dropped or second in dropped:
            continue
        a, b = outcome_corr.get(first), outcome_corr.get(second)
        weaker_first = a is not None and b is not None and round(a, 12) < round(b, 12)
        dropped[first if weaker_first else second] = None
    return list(dropped)


def features_to_drop(corr: DataFrame, features: Sequence[str], outcome: str = "y", threshold: float = 0.8) -> list[str]:
    pairs = [tuple(r) for r in redundant_pairs(corr, features, threshold).collect()]  # features squared at most
    strength = corr.filter((F.col("feature_2") == outcome) & F.col("feature_1").isin(list(features)))
    by_name = {r["feature_1"]: (None if r["corr"] is None else abs(r["corr"])) for r in strength.collect()}
    return greedy_drops(pairs, by_name)


def vif_values(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vif, collinear flag) without an intercept: G_ii times the i-th diagonal of the inverse.

    G is scaled to a unit diagonal. A feature with weight in its null space is an exact combination of others and
    has no finite VIF; an all-zero feature has none either.
    """
    size = np.sqrt(np.diag(gram))
    zero = size == 0.0
    scaled = gram / np.outer(np.where(zero, 1.0, size), np.where(zero, 1.0, size))
    scaled[zero, zero] = 1.0
    values, vectors = np.linalg.eigh(scaled)
    dead = values < NULL_SPACE
    weight = (vectors[:, dead] ** 2).sum(axis=1) if dead.any() else np.zeros(len(size))
    collinear = weight > 1e-8
    alive = ~dead
    inverse = (vectors[:, alive] ** 2 / values[alive]).sum(axis=1)
    return np.where(collinear | zero, np.nan, inverse), collinear


def vif(spark: SparkSession, m: Moments, features: Sequence[str]) -> DataFrame:
    """(feature, vif, is_collinear), largest first; an exact linear combination has null VIF and the flag set."""
    numbers, collinear = vif_values(m.gram(features))
    rows = [(c, _number(v), bool(x)) for c, v, x in zip(features, numbers, collinear)]
    return spark.createDataFrame(rows, "feature string, vif double, is_collinear boolean").orderBy(
        F.col("is_collinear").desc(), F.col("vif").desc_nulls_last(), "feature")


def selection_summary(spark: SparkSession, corr: DataFrame, m: Moments, features: Sequence[str], outcome: str = "y",
                      threshold: float = 0.8) -> DataFrame:
    """One row (n_features, n_high_corr, n_vif_high, n_dropped); VIF above 10, or none at all, counts as high."""
    numbers, collinear = vif_values(m.gram(features))
    high = int((collinear | (np.nan_to_num(numbers, nan=0.0) > 10)).sum())
    dropped = len(features_to_drop(corr, features, outcome, threshold))
    return redundant_pairs(corr, features, threshold).agg(
        F.lit(len(features)).cast("bigint").alias("n_features"), F.count("*").alias("n_high_corr"),
        F.lit(high).cast("bigint").alias("n_vif_high"), F.lit(dropped).cast("bigint").alias("n_dropped"))


def interaction_candidates(corr: DataFrame, features: Sequence[str], treatment: str = "treatment",
                           threshold: float = 0.1, limit: int = 15) -> DataFrame:
    """(feature, abs_corr): the ``limit`` features most correlated with treatment, above the threshold."""
    against = corr.filter((F.col("feature_2") == treatment) & F.col("feature_1").isin(list(features)))
    return against.select(F.col("feature_1").alias("feature"), F.abs("corr").alias("abs_corr")).filter(
        F.col("abs_corr") > threshold).orderBy(F.col("abs_corr").desc(), "feature").limit(limit)
