"""The most frequent topics of each region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.functions import not_in, period_label, recode
from epitally.operators.filters import at_period


def top_topics(
    monthly: DataFrame,
    by: str,
    report: Report,
    year: int,
    k: int = 5,
    relabel: Mapping[str, str] | None = None,
    labels: Labels | None = None,
) -> DataFrame:
    """Rank 1 to ``k`` per region by count, ties in topic order, no shared ranks.

    Topics without events take part, so a region always fills its ranks as long
    as there are topics. The ranking sees sums per topic, never events, and each
    task keeps only its best ``k`` rows per region before they are moved.
    """
    labels = labels or Labels()
    topic = recode(F.col(by), relabel) if relabel else F.col(by)
    totals = (
        at_period(monthly, year, report)
        .filter(F.col("region").isNotNull() & not_in(F.col("region"), [labels.all_regions]))
        .groupBy("region", period_label(F.col("month_start"), report).alias("period"), topic.alias(by))
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("region", "period").orderBy(F.desc("n"), F.asc_nulls_last(by))
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def pivot_topics(ranked: DataFrame, by: str, regions: Sequence[str]) -> DataFrame:
    """One row per rank, with the topic and count of each region side by side."""
    wide = ranked.groupBy("rank").pivot("region", list(regions)).agg(F.first(by).alias(by), F.first("n").alias("n"))
    pairs = (F.col(f"`{region}_{part}`") for region in regions for part in (by, "n"))
    return wide.select("rank", *pairs)
