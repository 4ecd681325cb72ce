"""The charts of the two kinds of report, as parameter sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from epitally.config import Labels
from epitally.operators.series import SeriesSpec, all_series, require_values, series

# Monthly tables that charts draw from, with the category column of each.
SOURCES = {
    "diseases": "category",
    "scenarios": "scenario",
    "scenario_agents": "scenario",
    "topics": "topic",
}

# The charts of the quarterly report.
QUARTERLY = (
    SeriesSpec("all_diseases", "diseases", exclude=("Scabies",)),
    SeriesSpec("without_pertussis", "diseases", exclude=("Kinkhoest (Pertussis)",)),
    SeriesSpec("pertussis", "diseases", include=("Kinkhoest (Pertussis)",)),
    SeriesSpec("pertussis_recent", "diseases", include=("Kinkhoest (Pertussis)",), years=(2023, 2024)),
    SeriesSpec("typhoid", "diseases", include=("Buiktyfus",)),
    SeriesSpec("mpox", "diseases", include=("Monkeypox",)),
    SeriesSpec("invasive_group_a_strep", "diseases", include=("Invasieve groep A-streptokokkeninfectie",)),
    SeriesSpec("invasive_pneumococcal", "diseases", include=("Invasieve pneumokokkenziekte",)),
    SeriesSpec("legionellosis", "diseases", include=("Legionellose",)),
    SeriesSpec("rabies", "diseases", include=("Rabies (Hondsdolheid)",)),
    SeriesSpec("scabies", "diseases", include=("Scabies",)),
    SeriesSpec("article_26", "scenarios"),
    SeriesSpec("gastroenteritis", "scenarios", include=("Gastroenteritis",)),
    SeriesSpec("rash", "scenarios", include=("Huiduitslag/exanthemen",)),
    SeriesSpec(
        "rash_varicella",
        "scenario_agents",
        include=("Huiduitslag/exanthemen",),
        breakdown=("agent", ("Varicella-zoster virus",)),
    ),
    SeriesSpec("enquiries", "topics"),
    SeriesSpec("enquiries_scabies", "topics", include=("Scabies (Schurft)",)),
    SeriesSpec("enquiries_measles", "topics", include=("Mazelen",), years=(2023, 2024)),
    SeriesSpec("enquiries_typhoid_other", "topics", include=("Buiktyfus", "Anders")),
)

# The yearly report has no all-year pertussis chart and no measles chart, and shows one pertussis year.
YEARLY = tuple(
    replace(spec, years=(2023,)) if spec.name == "pertussis_recent" else spec
    for spec in QUARTERLY
    if spec.name not in ("pertussis", "enquiries_measles")
)


def build_series(
    monthly: Mapping[str, DataFrame],
    specs: Sequence[SeriesSpec],
    labels: Labels | None = None,
    check: bool = True,
) -> dict[str, DataFrame]:
    if check:
        for source, by in SOURCES.items():
            wanted = [spec for spec in specs if spec.source == source]
            if wanted:
                require_values(monthly[source], by, wanted)
    return {spec.name: series(monthly[spec.source], SOURCES[spec.source], spec, labels) for spec in specs}


def build_charts(
    monthly: Mapping[str, DataFrame], specs: Sequence[SeriesSpec], labels: Labels | None = None
) -> dict[str, DataFrame]:
    """One table per source with all its charts, from one pass over the monthly table."""
    by_source: dict[str, list[SeriesSpec]] = {}
    for spec in specs:
        by_source.setdefault(spec.source, []).append(spec)
    return {source: all_series(monthly[source], SOURCES[source], own, labels) for source, own in by_source.items()}
