"""Denominators, incidence, and sums over months or breakdowns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.functions import incidence, not_in, period_label


def with_incidence(df: DataFrame, population: DataFrame) -> DataFrame:
    """Attach the population of (region, year) and the incidence per million.

    ``population`` has one row per region and report year; more than one stops
    the job, as each would count the events again. Rows without one keep a NULL
    incidence.
    """
    twice = F.raise_error(F.concat_ws(" ", F.lit("population: more than one row for"), "region", "year"))
    denominators = population.groupBy("region", "year").agg(
        F.when(F.count("*") > 1, twice.cast("long")).otherwise(F.max("population")).alias("population")
    )
    return (
        df.withColumn("year", F.year("month_start"))
        .join(denominators, ["region", "year"], "left")
        .withColumn("incidence", incidence(F.col("n"), F.col("population")))
    )


def summed_incidence() -> Column:
    """Incidence of several rows of one region and year.

    They share one population, so the sum of their incidences is the summed
    count over that population: exact in any row order. A missing population
    counts as an incidence of 0.
    """
    return F.coalesce(incidence(F.sum("n"), F.max("population")), F.lit(0.0))


def _summed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.max("population").alias("population"),
        summed_incidence().alias("incidence"),
    )


def to_period(monthly: DataFrame, by: Sequence[str], report: Report) -> DataFrame:
    """Months summed to quarters or years, depending on the report."""
    labelled = monthly.withColumn("period", period_label(F.col("month_start"), report))
    return _summed(labelled, ["region", "year", "period", *by])


def drop_breakdown(
    monthly: DataFrame, keep: Sequence[str], breakdown: str, exclude: Iterable[str] = ()
) -> DataFrame:
    """Sum over a second category column after leaving some of its values out."""
    exclude = tuple(exclude)
    kept = monthly.filter(not_in(F.col(breakdown), exclude)) if exclude else monthly
    return _summed(kept, ["region", "year", "month_start", *keep])
