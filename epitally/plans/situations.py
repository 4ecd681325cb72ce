"""Outbreak situations: cleaning, scenario and setting tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally import fixed_values as fixed
from epitally.config import Labels, SurveillanceConfig
from epitally.functions import id_prefix, map_region, parse_day_month_year
from epitally.operators.facts import Counted
from epitally.operators.period_table import SITUATION_STYLE, period_table
from epitally.operators.rates import drop_breakdown
from epitally.plans.monthly import less_detail, monthly_incidence

DETAIL = ["scenario", "agent", "setting"]


def clean_situations(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Article-26 situations as ``region``, ``event_date``, ``scenario``, ``agent``, ``setting`` and the columns to ``keep``."""
    return (
        raw.filter(F.col("article_26") == fixed.ARTICLE_26_VALUE)
        .select(
            map_region(id_prefix(F.col("name")), fixed.REGION_BY_PREFIX).alias("region"),
            parse_day_month_year(F.col("date_entered")).alias("event_date"),
            *DETAIL,
            *keep,
        )
        .fillna(fixed.EMPTY_LABEL, ["scenario", "setting"])
    )


def scenario_agent_monthly(counts: Counted, population: DataFrame, regions: Sequence[str], labels: Labels | None = None) -> DataFrame:
    """Monthly incidence per (scenario, agent) pair that occurs; two columns, never glued together."""
    pairs = ["scenario", "agent"]
    return monthly_incidence(less_detail(counts.frame, pairs), pairs, population, regions, None, labels, counts.facts)


def scenario_chart_monthly(scenario_agent: DataFrame) -> DataFrame:
    """Per scenario, without the agents that charts leave out."""
    return drop_breakdown(scenario_agent, ["scenario"], "agent", fixed.AGENTS_OUTSIDE_CHARTS)


def setting_monthly(counts: Counted, population: DataFrame, regions: Sequence[str], labels: Labels | None = None) -> DataFrame:
    return monthly_incidence(less_detail(counts.frame, ["setting"]), ["setting"], population, regions, None, labels, counts.facts)


def situation_table(
    monthly: DataFrame, by: str, config: SurveillanceConfig, year: int
) -> DataFrame:
    """Scenario or setting table; agents are all in, the nation is not."""
    return period_table(
        monthly, by, config.report, year, config.regions, SITUATION_STYLE, labels=config.labels
    )
