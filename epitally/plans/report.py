"""A whole report: guards, tables and chart series from the input tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame

from epitally.config import SurveillanceConfig
from epitally.operators.checks import CoverageError, require_coverage, require_denominators
from epitally.operators.series import SeriesSpec
from epitally.plans import cases, enquiries, situations
from epitally.plans.catalogue import QUARTERLY, YEARLY, build_charts, build_series
from epitally.plans.monthly import counted
from epitally.staging import stage


@dataclass(frozen=True)
class ReportInputs:
    """Raw tables with the columns of ``sources.schemas``; population in long form.

    ``list_order`` of the name link tells which of several local names comes first.
    """

    cases: DataFrame
    situations: DataFrame
    enquiries: DataFrame
    national: DataFrame
    name_link: DataFrame
    population: DataFrame
    modified: Mapping[str, datetime] = field(default_factory=dict)


@dataclass(frozen=True)
class SurveillanceReport:
    year: int
    comparison_label: str
    tables: dict[str, DataFrame]
    series: dict[str, DataFrame]
    #: The same series by source, those of a source in one table with the name of the ``chart``.
    charts: dict[str, DataFrame]
    #: When the files of the event inputs were last written.
    modified: Mapping[str, datetime]


def build_report(
    inputs: ReportInputs, config: SurveillanceConfig, specs: Sequence[SeriesSpec] | None = None, check: bool = True
) -> SurveillanceReport:
    """Scan each event table once, check coverage, and derive everything else from the counts."""
    report, labels = config.report, config.labels
    counts = {
        "cases": counted(cases.clean_cases(inputs.cases), ["category"], report, "cases", config.regions),
        "situations": counted(
            situations.clean_situations(inputs.situations), situations.DETAIL, report, "situations", config.regions
        ),
        "enquiries": counted(enquiries.clean_enquiries(inputs.enquiries), ["topic"], report, "enquiries", config.regions),
    }
    # The year of the cases is the year of the whole report.
    year = counts["cases"].facts.year
    if year is None:
        raise CoverageError("cases: no dated rows")
    for name, found in counts.items():
        require_coverage(found.facts, name, report, year)
    require_denominators(inputs.population, year, [*config.regions, labels.all_regions, labels.national])

    population = inputs.population
    link = inputs.name_link
    scenario_agents = situations.scenario_agent_monthly(counts["situations"], population, config.regions, labels)
    monthly = {
        "diseases": cases.disease_monthly(counts["cases"], population, link, config.regions, labels),
        "scenario_agents": scenario_agents,
        "scenarios": situations.scenario_chart_monthly(scenario_agents),
        "settings": situations.setting_monthly(counts["situations"], population, config.regions, labels),
        "topics": enquiries.topic_monthly(counts["enquiries"], population, config.regions, labels),
    }
    # Tables and some twenty charts read these.
    monthly = {name: stage(df, name) for name, df in monthly.items()}

    national = cases.national_incidence(
        cases.harmonise_names(inputs.national, cases.first_link(link)), population, year, labels
    )
    specs = specs if specs is not None else (YEARLY if report.yearly else QUARTERLY)
    return SurveillanceReport(
        year=year,
        comparison_label=report.comparison_label(config.display_name, year),
        tables={
            "diseases": cases.disease_table(monthly["diseases"], national, config, year),
            "scenarios": situations.situation_table(monthly["scenario_agents"], "scenario", config, year),
            "settings": situations.situation_table(monthly["settings"], "setting", config, year),
            "top_topics": enquiries.top5_table(monthly["topics"], config, year),
        },
        series=build_series(monthly, specs, labels, check),
        charts=build_charts(monthly, specs, labels),
        modified=inputs.modified,
    )
