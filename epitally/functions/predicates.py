"""Membership tests that treat NULL as an ordinary value outside the list.

Both forms are never NULL themselves, so they can be negated and combined
freely, and both still reach the Parquet reader as pushed filters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(col: Column, values: Iterable) -> Column:
    """True for listed values; False for others. NULL is one of the values if None is listed."""
    plain, null = _split(values)
    if not plain:
        return col.isNull() if null else F.lit(False)
    found = col.isNotNull() & col.isin(*plain)
    return col.isNull() | found if null else found


def not_in(col: Column, values: Iterable) -> Column:
    """False for listed values; True for others. NULL is one of the values if None is listed."""
    plain, null = _split(values)
    if not plain:
        return col.isNotNull() if null else F.lit(True)
    return col.isNotNull() & ~col.isin(*plain) if null else col.isNull() | ~col.isin(*plain)


def _split(values: Iterable) -> tuple[list, bool]:
    values = list(values)
    return [v for v in values if v is not None], None in values
