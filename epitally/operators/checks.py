"""Checks that stop a report whose inputs do not cover it.

Each check brings back a handful of scalars. They are meant for the small
monthly tables, not for events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.operators.facts import CountFacts


class CoverageError(ValueError):
    """An input does not cover what the report asks for."""


def coverage_flags(windowed: DataFrame, report: Report, year: int, date_col: str = "month_start") -> DataFrame:
    """One row: first and latest year, and whether the report can be made.

    The report quarter is covered when the latest year that has it is the latest
    year of all; a yearly report has no such demand.
    """
    date = F.col(date_col)
    spans = windowed.agg(
        F.min(F.year(date)).alias("first_year"),
        F.max(F.year(date)).alias("latest_year"),
        F.max(F.when(F.quarter(date) == report.kind, F.year(date))).alias("_latest_with_quarter"),
    )
    covered = F.lit(True) if report.yearly else F.col("_latest_with_quarter").eqNullSafe(F.col("latest_year"))
    return spans.select(
        "first_year",
        "latest_year",
        (covered & F.col("latest_year").isNotNull()).alias("period_covered"),
        F.coalesce(F.col("first_year") <= year, F.lit(False)).alias("starts_in_time"),
    )


def require_coverage(windowed: DataFrame | CountFacts, name: str, report: Report, year: int) -> None:
    """Counts are asked by a job; facts that came with their write need none."""
    flags = windowed.coverage(report, year) if isinstance(windowed, CountFacts) else coverage_flags(windowed, report, year).first()
    if not flags["period_covered"]:
        raise CoverageError(f"{name}: no rows in period {report.kind} of {flags['latest_year']}")
    if not flags["starts_in_time"]:
        raise CoverageError(f"{name}: starts in {flags['first_year']}, after the report year")


def denominator_flags(population: DataFrame, year: int, regions: Sequence[str] = ()) -> DataFrame:
    """One row: the latest year with a known population, whether it serves the report year (its own
    year plus one), and whether each of ``regions`` has a known population for the report year."""
    known = population.filter(F.col("population").isNotNull())
    serving = F.when((F.col("pop_year") == year - 1) & F.col("region").isin(*regions), F.col("region")) if regions else F.lit(None)
    facts = known.agg(F.max("pop_year").alias("latest_pop_year"), F.count_distinct(serving).alias("_regions"))
    return facts.select(
        "latest_pop_year",
        F.coalesce(F.col("latest_pop_year") >= year - 1, F.lit(False)).alias("fresh"),
        (F.col("_regions") == len(set(regions))).alias("complete"),
    )


def require_denominators(population: DataFrame, year: int, regions: Sequence[str] = ()) -> None:
    flags = denominator_flags(population, year, regions).first()
    if not flags["fresh"]:
        raise CoverageError(f"population: latest year {flags['latest_pop_year']}, too old for report year {year}")
    if not flags["complete"]:
        raise CoverageError(f"population: not known in {year - 1} for each of {', '.join(regions)}")
