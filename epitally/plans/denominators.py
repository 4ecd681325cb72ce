"""Population table: regions, supra-region and nation per year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally import fixed_values as fixed
from epitally.config import Labels
from epitally.functions import recode
from epitally.operators.population import (
    national_population,
    pivot_population,
    population_by_region,
    unpivot_years,
    with_report_year,
)


def population_table(
    observations: DataFrame,
    area_map: DataFrame,
    boundaries: str = "per_year",
    boundary_year: int | None = None,
    region_names: Mapping[str, str] = fixed.REGION_BY_STATISTICS_NAME,
    nation_code: str = fixed.NATION_CODE,
    labels: Labels | None = None,
) -> DataFrame:
    """Long table of ``region``, ``pop_year``, ``population`` and report ``year``.

    All years go through one join on municipality (and year), not one query each.
    With boundaries per year, the nation is limited to the years that have regions.
    """
    regional = population_by_region(observations, area_map, region_names, boundaries, boundary_year, labels)
    years = regional if boundaries == "per_year" else None
    national = national_population(observations, nation_code, years, labels)
    return with_report_year(regional.unionByName(national))


def wide_population(population: DataFrame, years: Sequence[int]) -> DataFrame:
    return pivot_population(population, years)


def population_from_wide(wide: DataFrame, row_labels: Mapping[str, str] = fixed.POPULATION_ROW_LABELS) -> DataFrame:
    """Long form of a stored wide table; its special rows get this library's labels."""
    return unpivot_years(wide).withColumn("region", recode(F.col("region"), row_labels))
