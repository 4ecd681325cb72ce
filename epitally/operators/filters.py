"""Admission of events and the report window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.functions import in_period, is_in, not_in


def admitted(
    confidence: Column,
    deleted: Column,
    status: Column,
    category: Column,
    *,
    confidences: Iterable[str],
    statuses: Iterable[str],
    exempt_categories: Iterable[str],
    blocked_statuses: Iterable[str],
) -> Column:
    """Sure enough, not deleted, and with a settled status.

    Exempt categories need no settled status, just not a blocked one; having no
    status at all is fine for them.
    """
    settled = is_in(status, statuses)
    # The category is often computed; it is looked at last, and once.
    exempt = not_in(status, blocked_statuses) & F.coalesce(category.isin(*exempt_categories), F.lit(False))
    return is_in(confidence, confidences) & deleted.isNull() & (settled | exempt)


def report_window(df: DataFrame, report: Report, date_col: str = "event_date") -> DataFrame:
    """All earlier years, and the latest year up to the end of the report period.

    The latest date is fetched, which makes the window a plain range of dates that
    reaches the scan. That reads the dates of ``df`` once more; where counts will
    do, ``window_counts`` on written monthly counts needs one pass in all. Rows
    without a date drop out.
    """
    latest = df.agg(F.max(date_col)).first()[0]
    return df.filter(F.lit(False) if latest is None else F.col(date_col) < report.window_end(latest))


def window_counts(counts: DataFrame, report: Report) -> DataFrame:
    """The same window on small, written monthly counts.

    Months suffice to decide it. The latest one is fetched, which turns the
    window into a plain range of dates for everything that builds on it.
    """
    latest = counts.agg(F.max("month_start")).first()[0]
    return counts.filter(F.lit(False) if latest is None else F.col("month_start") < report.window_end(latest))


def report_year(counts: DataFrame) -> int | None:
    """Year of the latest month; None without any."""
    return counts.agg(F.max(F.year("month_start"))).first()[0]


def at_period(df: DataFrame, year: int, report: Report, date_col: str = "month_start") -> DataFrame:
    """Rows of the report period of one year."""
    return df.filter(in_period(F.col(date_col), year, report))
