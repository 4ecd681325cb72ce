"""Rates, rounding and the two ways of summing over NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def incidence(n: Column, population: Column, per: float = 1e6) -> Column:
    """Events per ``per`` inhabitants; NULL without a (positive) population."""
    return F.try_divide(n, population) * F.lit(float(per))


def round_half_away(col: Column, digits: int = 0) -> Column:
    """Halves go away from zero, as on paper."""
    scale = F.lit(10.0**digits)
    # Adding 0.0 turns a negative zero into a plain one.
    return F.signum(col) * F.floor(F.abs(col) * scale + F.lit(0.5)) / scale + F.lit(0.0)


def mask_zero(col: Column) -> Column:
    return F.nullif(col, F.lit(0).cast("long"))


def sum_or_zero(col: Column) -> Column:
    """Sum that skips NULL; 0 when nothing is left."""
    return F.coalesce(F.sum(col), F.lit(0).cast("long"))


def null_propagating_sum(col: Column) -> Column:
    """Sum that is NULL as soon as one value is NULL."""
    return F.when(F.count("*") == F.count(col), F.sum(col))
