"""Telephone enquiries: cleaning, monthly incidence, top topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally import fixed_values as fixed
from epitally.config import Labels, SurveillanceConfig
from epitally.functions import map_region, not_in, parse_leading_date
from epitally.operators.facts import Counted
from epitally.operators.topics import pivot_topics, top_topics
from epitally.plans.monthly import monthly_incidence


def clean_enquiries(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Enquiries on infectious diseases as ``region``, ``event_date``, ``topic`` and the columns to ``keep``."""
    return raw.filter(
        (F.col("broad_topic") == fixed.ENQUIRY_BROAD_TOPIC)
        & F.col("received_on").isNotNull()
        & not_in(F.col("topic"), fixed.EXCLUDED_TOPICS)
    ).select(
        map_region(F.col("region_name"), fixed.REGION_BY_ENQUIRY_NAME, default=None).alias("region"),
        parse_leading_date(F.col("received_on")).alias("event_date"),
        "topic",
        *keep,
    )


def topic_monthly(counts: Counted, population: DataFrame, regions: Sequence[str], labels: Labels | None = None) -> DataFrame:
    return monthly_incidence(counts.frame, ["topic"], population, regions, None, labels, counts.facts)


def top5_long(monthly: DataFrame, config: SurveillanceConfig, year: int) -> DataFrame:
    return top_topics(
        monthly, "topic", config.report, year, k=5, relabel=fixed.TOPIC_RELABELS, labels=config.labels
    )


def top5_table(monthly: DataFrame, config: SurveillanceConfig, year: int) -> DataFrame:
    return pivot_topics(top5_long(monthly, config, year), "topic", config.regions)
