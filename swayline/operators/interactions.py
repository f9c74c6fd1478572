"""Treatment interactions, inverse-propensity weights and the arithmetic between learners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

TREATMENT_PREFIX = "outreach_x_"
PRIORITY_PREFIX = "clinical_x_"


def interaction_columns(features: Sequence[str], treatment: Column, prefix: str = TREATMENT_PREFIX) -> dict[str, Column]:
    return {f"{prefix}{f}": treatment * F.col(f) for f in features}


def add_interactions(df: DataFrame, features: Sequence[str], treatment: str = "treatment",
                     prefix: str = TREATMENT_PREFIX) -> DataFrame:
    """``prefix + feature = treatment * feature`` for each listed feature that exists."""
    present = [f for f in features if f in df.columns]
    return df.withColumns(interaction_columns(present, F.col(treatment), prefix)) if present else df


def clipped(p: Column, clip: float | None) -> Column:
    return p if clip is None else F.greatest(F.lit(clip), F.least(F.lit(1.0 - clip), p))


def inverse_weight(treatment: Column, propensity: Column, clip: float | None = None) -> Column:
    """``1/p`` for treated, ``1/(1-p)`` for control members; unbounded unless ``clip`` is set."""
    p = clipped(propensity, clip)
    return F.when(treatment == 1, F.try_divide(F.lit(1.0), p)).otherwise(F.try_divide(F.lit(1.0), 1.0 - p))


def weight_report(df: DataFrame, propensity: str, clip: float, treatment: str = "treatment") -> DataFrame:
    """Per arm: members, rows whose propensity a clip would change, and the largest unclipped weight."""
    p = F.col(propensity)
    return df.groupBy(treatment).agg(
        F.count("*").alias("members"), F.count_if((p < clip) | (p > 1.0 - clip)).alias("clipped"),
        F.max(inverse_weight(F.col(treatment), p)).alias("max_weight"))


def uplift_difference(p_treated: Column, p_control: Column) -> Column:
    return p_treated - p_control


def imputed_effect(treatment: Column, y: Column, mu0: Column, mu1: Column) -> Column:
    """Observed minus predicted untreated outcome for the treated; predicted treated minus observed for controls."""
    return F.when(treatment == 1, y - mu0).otherwise(mu1 - y)


def blended_effect(propensity: Column, tau0: Column, tau1: Column) -> Column:
    return propensity * tau0 + (1.0 - propensity) * tau1


def doubly_robust(treatment: Column, y: Column, p: Column, m0: Column, m1: Column, clip: float) -> Column:
    """Outcome-model difference corrected by propensity-weighted residuals of the member's own arm."""
    safe = clipped(p, clip)
    correction = F.when(treatment == 1, (y - m1) / safe).otherwise((m0 - y) / (1.0 - safe))
    return m1 - m0 + correction
