"""The path every data set takes from events to dense monthly incidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.operators.counts import monthly_counts, with_all_regions, zero_filled
from epitally.operators.facts import CountFacts, Counted, write_counts
from epitally.operators.rates import with_incidence


def counted(events: DataFrame, by: Sequence[str], report: Report, name: str, regions: Sequence[str] = ()) -> Counted:
    """Monthly counts inside the report window, and what they cover, from one scan of the events.

    Counting comes before the window: the window depends on whole months only,
    and writing the counts tells the latest month.
    """
    return write_counts(monthly_counts(events, by), name, regions)[name].window(report)


def windowed_counts(events: DataFrame, by: Sequence[str], report: Report, name: str) -> DataFrame:
    """The counts alone."""
    return counted(events, by, report, name).frame


def monthly_incidence(
    counts: DataFrame,
    by: Sequence[str],
    population: DataFrame,
    regions: Sequence[str],
    categories: DataFrame | None = None,
    labels: Labels | None = None,
    facts: CountFacts | None = None,
) -> DataFrame:
    """Dense counts per region and month with supra-region, population and incidence.

    ``facts`` spares a job that asks the counts what they cover. Events of regions outside the list are one region, and count in the supra-region.
    """
    labels = labels or Labels()
    filled = zero_filled(counts, by, regions, categories, labels, facts)
    return with_incidence(with_all_regions(filled, by, labels), population)


def less_detail(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts over fewer category columns, from counts that have more."""
    return counts.groupBy("region", "month_start", *by).agg(F.sum("n").alias("n"))
