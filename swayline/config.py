"""Settings passed to the operators. Nothing here touches a session."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date

# Diagnosis codes that get a 0/1 flag per member.
PRIORITY_CODES = ("Z71.3", "J00", "M54.5", "I10", "E11.9", "K21.9", "R51", "A09", "B34.9", "H10.9")

# Keywords that mark a feature as a clinical or engagement priority.
PRIORITY_KEYWORDS = ("e11.9", "i10", "z71.3", "claims_count", "app_logins", "web_visits")

# A column whose name contains one of these counts something, so "no record" means 0.
COUNT_NAME_PARTS = ("count", "usage", "visits", "claims")

# Columns of the joined member table that are not model inputs.
NON_FEATURES = (
    "signup_date", "churn", "outreach", "treatment", "y",
    "first_session", "last_session", "last_claim", "last_visit", "member_id",
)
# The date columns of the member table, and the form of a visit's address.
DATE_COLUMNS = ("first_session", "last_session", "last_visit", "last_claim")

URL_PATTERN = r"https://([^/]+)/([^/]+)/(\d+)"

# Parts in brackets may be missing; days, months and hours have one digit or two.
YEAR_FIRST_FORMATS = ("yyyy-M-d[ H:mm[:ss[.SSSSSSSSS]]]", "yyyy-M-d'T'H:mm[:ss[.SSSSSSSSS]]")
DAY_FIRST_FORMATS = ("d/M/yyyy[ H:mm[:ss[.SSSSSSSSS]]]", "d-M-yyyy[ H:mm[:ss[.SSSSSSSSS]]]")


def safe_name(text: str) -> str:
    """Column-name form of a code: dots and other separators become underscores."""
    return re.sub(r"[^0-9A-Za-z_]", "_", text)


@dataclass(frozen=True)
class FeatureConfig:
    """Dates, codes and text formats of one observation window.

    ``own_domain_token`` has no default: it is the text that marks a visit to the organisation's own site.
    """

    own_domain_token: str
    reference_date: date = date(2025, 7, 14)
    mid_date: date = date(2025, 7, 7)
    default_date: date = date(2025, 7, 1)
    claims_mid_date: date | None = None
    priority_codes: tuple[str, ...] = PRIORITY_CODES
    category_column: str = "icd_code"
    web_time_formats: tuple[str, ...] = YEAR_FIRST_FORMATS

    @property
    def claims_mid(self) -> date:
        return self.claims_mid_date or self.mid_date

    @property
    def flag_names(self) -> dict[str, str]:
        return {code: f"has_icd_{safe_name(code)}" for code in self.priority_codes}


@dataclass(frozen=True)
class CurveConfig:
    """How global running sums are split into tasks: buckets hold about this many rows, whatever the table size."""

    rows_per_bucket: int = 500_000


@dataclass(frozen=True)
class DriftConfig:
    std_share: float = 0.2
    frequency_gap: float = 0.1


@dataclass(frozen=True)
class PropensityConfig:
    c: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-6


@dataclass(frozen=True)
class SoloConfig:
    c: float = 0.2
    l1_ratio: float = 0.1
    max_iter: int = 5000
    tol: float = 1e-6


@dataclass(frozen=True)
class ForestConfig:
    """``max_depth`` 0: no limit. ``feature_share`` 0: a square root of the features is tried at each node."""

    num_trees: int = 100
    max_depth: int = 0
    min_instances: int = 1
    seed: int = 42
    feature_share: float = 0.0


@dataclass(frozen=True)
class BoostConfig:
    """One gradient-boosted classifier. ``subsampling`` acts when ``bagging_freq`` is set: a bag of that share every so many trees.
    ``tree_share`` is drawn for every tree on its own. ``max_depth`` 0: no limit but ``num_leaves``."""

    max_iter: int = 100
    max_depth: int = 3
    step_size: float = 0.1
    min_instances: int = 100
    subsampling: float = 1.0
    feature_share: float = 0.7
    seed: int = 42
    num_leaves: int = 10
    l1: float = 0.5
    l2: float = 0.5
    min_split_gain: float = 0.1
    min_child_weight: float = 1e-3
    bagging_freq: int = 0
    tree_share: float = 0.7


# The control arm's baseline, and the stored best parameters of the random search.
CONTROL_BOOST = BoostConfig(seed=43, l1=10.0, l2=5.0)
TUNED_BOOST = BoostConfig(
    max_iter=225, max_depth=5, step_size=0.001, min_instances=400, feature_share=1.0, num_leaves=31,
    l1=1.0, l2=0.3, min_split_gain=0.02, min_child_weight=5.0, subsampling=0.9, bagging_freq=0, tree_share=0.4,
)


@dataclass(frozen=True)
class CrossFitConfig:
    folds: int = 5
    repeats: int = 3
    seed: int = 42
    clip: float = 1e-6
    forest: ForestConfig = field(default_factory=lambda: ForestConfig(100, 3, 10, 42, 1.0))
    final_iter: int = 100
    final_depth: int = 3
    final_min_instances: int = 10


# Options of the random parameter search.
SEARCH_SPACE: dict[str, tuple] = {
    "n_estimators": (50, 75, 100, 125, 150, 175, 200, 225, 250, 300, 350, 400, 500),
    "max_depth": (2, 3, 4, 5, 6, 7, 8, 9, 10),
    "learning_rate": (0.001, 0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2),
    "min_child_samples": (20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 750),
    "reg_alpha": (0.0, 0.01, 0.05, 0.1, 0.3, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0),
    "reg_lambda": (0.0, 0.01, 0.05, 0.1, 0.3, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0),
    "num_leaves": (7, 10, 15, 20, 25, 31, 40, 50, 64, 80),
    "subsample": (0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0),
    "colsample_bytree": (0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0),
    "min_split_gain": (0.0, 0.0005, 0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "min_child_weight": (1e-6, 1e-4, 1e-3, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0),
    "bagging_freq": (0, 1, 2, 5, 10),
    "bagging_fraction": (0.5, 0.6, 0.7, 0.8, 0.9),
}
