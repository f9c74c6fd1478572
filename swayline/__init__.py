"""Uplift and treatment-effect analytics on Spark DataFrames."""

from swayline.config import CurveConfig, FeatureConfig

__all__ = ["CurveConfig", "FeatureConfig"]
