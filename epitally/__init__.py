"""Regional incidence surveillance on Spark DataFrames."""

from epitally.config import Labels, Report, SurveillanceConfig

__all__ = ["Labels", "Report", "SurveillanceConfig"]
