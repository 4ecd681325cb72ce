"""Population denominators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Labels
from epitally.functions import recode


def year_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if re.fullmatch("[0-9]{4}", name)]


def unpivot_years(wide: DataFrame, years: Sequence[str] | None = None, region: str = "region") -> DataFrame:
    """One row per region and year. The count of 1 January serves the year after."""
    years = list(years) if years is not None else year_columns(wide)
    return (
        wide.select(F.col(region).alias("region"), *(F.col(f"`{y}`").try_cast("double").try_cast("long").alias(y) for y in years))
        .unpivot(["region"], years, "pop_year", "population")
        .withColumn("pop_year", F.col("pop_year").cast("int"))
        .withColumn("year", F.col("pop_year") + 1)
    )


def with_period_parts(df: DataFrame, col: str = "period_code") -> DataFrame:
    """Split a period code into year, month and granularity."""
    code = F.trim(col)
    part = F.substring(code, 5, 2)
    return df.withColumns(
        {
            "pop_year": F.substring(code, 1, 4).try_cast("int"),
            "month": F.when(part == "MM", F.substring(code, 7, 2).try_cast("int")),
            "granularity": F.when(part == "MM", F.lit("month")).when(part == "JJ", F.lit("year")),
        }
    )


def first_of_year(observations: DataFrame) -> DataFrame:
    """Observations of the first month of a year."""
    parts = with_period_parts(observations)
    return parts.filter(F.col("month") == 1).select(F.trim("municipality").alias("municipality"), "pop_year", "population")


def _regional_sum(skip_nulls: bool) -> Column:
    complete = F.lit(True) if skip_nulls else F.every("_complete")
    return F.when(complete, F.coalesce(F.sum("_sum"), F.lit(0).cast("long")))


def population_by_region(
    observations: DataFrame,
    area_map: DataFrame,
    region_names: Mapping[str, str],
    boundaries: str = "per_year",
    boundary_year: int | None = None,
    labels: Labels | None = None,
) -> DataFrame:
    """Population per report region and year, with the supra-region.

    ``per_year`` uses the municipal boundaries of each year; an unknown municipal
    count makes its region unknown. ``fixed`` applies the boundaries of one year
    to all years and skips unknown counts; municipalities that no longer exist in
    that year drop out.
    """
    labels = labels or Labels()
    wanted = area_map.filter(F.col("region_name").isin(*region_names))
    if boundaries == "per_year":
        areas = wanted.select("municipality", F.col("boundary_year").alias("pop_year"), "region_name")
        keys, skip_nulls = ["municipality", "pop_year"], False
    elif boundaries == "fixed":
        if boundary_year is None:
            raise ValueError("fixed boundaries need a boundary year")
        areas = wanted.filter(F.col("boundary_year") == boundary_year).select("municipality", "region_name")
        keys, skip_nulls = ["municipality"], True
    else:
        raise ValueError("boundaries must be 'per_year' or 'fixed'")

    # Partial sums per region first; the supra-region then adds tens of rows.
    per_region = (
        first_of_year(observations)
        .join(areas, keys)
        .groupBy("region_name", "pop_year")
        .agg(F.sum("population").alias("_sum"), F.every(F.col("population").isNotNull()).alias("_complete"))
    )
    name = recode(F.col("region_name"), region_names)
    return (
        per_region.groupingSets([["region_name", "pop_year"], ["pop_year"]], "region_name", "pop_year")
        .agg(_regional_sum(skip_nulls).alias("population"), F.grouping("region_name").alias("_all"))
        .select(
            F.when(F.col("_all") == 1, F.lit(labels.all_regions)).otherwise(name).alias("region"),
            "pop_year",
            "population",
        )
    )


def national_population(
    observations: DataFrame, nation_code: str, years: DataFrame | None = None, labels: Labels | None = None
) -> DataFrame:
    """Population of the nation per year, optionally only for the years in a table."""
    labels = labels or Labels()
    nation = first_of_year(observations.filter(F.trim("municipality") == nation_code)).select(
        F.lit(labels.national).alias("region"), "pop_year", "population"
    )
    return nation if years is None else nation.join(years.select("pop_year").distinct(), "pop_year", "left_semi")


def with_report_year(population: DataFrame) -> DataFrame:
    return population.withColumn("year", F.col("pop_year") + 1)


def pivot_population(population: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per region and one column per year."""
    return population.groupBy("region").pivot("pop_year", list(years)).agg(F.first("population"))
