"""Reading the inputs of a report from files, and writing its results."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from epitally.operators.population import unpivot_years, year_columns
from epitally.plans.denominators import population_from_wide, population_table, wide_population
from epitally.plans.report import ReportInputs, SurveillanceReport
from epitally.sources import (
    modification_times,
    normalize_columns,
    period_codes,
    read_area_map,
    read_events,
    read_population,
    read_texts,
    resolve_region_columns,
    schemas,
    write_table,
)
from epitally.sources.versions import commit, commit_table, current_version, new_version, read_table

# Fixed value: header of the region column in the wide population table.
REGION_HEADER = "GGD"


@dataclass(frozen=True)
class InputPaths:
    """Files or folders, CSV or Parquet; the population is the wide table."""

    cases: str
    situations: str
    enquiries: str
    national: str
    name_link: str
    population: str


def read_wide_population(spark: SparkSession, path: str) -> DataFrame:
    """Region and one column per year, in long form."""
    if path.rstrip("/").endswith(".parquet"):
        wide = normalize_columns(read_table(spark, path))
    else:
        texts = read_texts(spark, path)
        years = year_columns(texts)
        wide = read_events(spark, path, [schemas.InputColumn(c, c, "double" if c in years else "string") for c in texts.columns])
    if REGION_HEADER in wide.columns:
        wide = wide.withColumnRenamed(REGION_HEADER, "region")
    return population_from_wide(wide)


@dataclass(frozen=True)
class PopulationSources:
    """Files that the population table is made from; boundary years map to their area table and its column dictionary."""

    observations: str
    area_tables: Mapping[int, str]
    dictionaries: Mapping[int, str]
    boundaries: str = "per_year"
    first_year: int | None = None
    last_year: int | None = None

    @property
    def years(self) -> range:
        first = min(self.area_tables) if self.first_year is None else self.first_year
        last = max(self.area_tables) if self.last_year is None else self.last_year
        return range(first, last + 1)

    def boundary_year(self, year: int) -> int:
        """The year whose area table gives the regions of ``year``."""
        return max(self.area_tables) if self.boundaries == "fixed" else year

    def files(self, year: int) -> list[str]:
        own = self.boundary_year(year)
        return [self.observations, *(tables[own] for tables in (self.area_tables, self.dictionaries) if own in tables)]


def read_inputs(
    spark: SparkSession,
    paths: InputPaths,
    splittable: Collection[str] = (),
    population: PopulationSources | None = None,
    rejects: str | None = None,
) -> ReportInputs:
    """The inputs of a report. ``splittable`` names those whose CSV files have no line breaks inside quotes.

    With ``population`` the population table is made first where it is absent or older
    than its sources. ``rejects`` is a folder for the tables of texts that are no numbers.
    """

    def read(name: str, schema: Sequence[schemas.InputColumn], **more) -> DataFrame:
        return read_events(spark, getattr(paths, name), schema, multi_line=name not in splittable, **more)

    if population is not None:
        ensure_population(spark, population, paths.population)
    listed = None if rejects is None else f"{rejects.rstrip('/')}/national"
    times = modification_times(spark, [paths.cases, paths.situations, paths.enquiries])
    modified = {name: times[getattr(paths, name)] for name in ("cases", "situations", "enquiries")}
    return ReportInputs(
        cases=read("cases", schemas.CASES),
        situations=read("situations", schemas.SITUATIONS, duplicated=["Infectious.Agent"]),
        enquiries=read("enquiries", schemas.ENQUIRIES),
        national=read("national", schemas.NATIONAL, rejects=listed),
        name_link=read("name_link", schemas.NAME_LINK, order="list_order"),
        population=read_wide_population(spark, paths.population),
        modified=modified,
    )


def _population_of(spark: SparkSession, sources: PopulationSources, years: Collection[int]) -> DataFrame:
    """Long population table of some years, from the files that these years need."""
    boundary_years = {sources.boundary_year(y) for y in years} & set(sources.area_tables)
    columns = {y: resolve_region_columns(read_texts(spark, sources.dictionaries[y])) for y in sorted(boundary_years)}
    codes = [code for y in sorted(years) for code in period_codes(y, y)]
    return population_table(
        read_population(spark, sources.observations, codes),
        read_area_map(spark, {y: sources.area_tables[y] for y in boundary_years}, columns),
        sources.boundaries,
        boundary_year=max(sources.area_tables) if sources.boundaries == "fixed" else None,
    )


def _states(spark: SparkSession, sources: PopulationSources) -> dict[str, dict[str, str]]:
    """For each year the files it is made from, with their times. The content of the files is not read."""
    times = modification_times(spark, [path for y in sources.years for path in sources.files(y)])
    return {str(y): {path: times[path].isoformat() for path in sources.files(y)} for y in sources.years}


def ensure_population(spark: SparkSession, sources: PopulationSources, output: str) -> list[int]:
    """Brings the population table up to date and returns the years that were made anew.

    These are the years that the table lacks, and those made from other files or from
    files that have been written since. The others are taken over from the current
    version. Nothing is written if nothing is missing, and a failure leaves the table as it was.
    """
    before, states = current_version(spark, output), _states(spark, sources)
    made = before.facts.get("years", {}) if before and before.facts.get("boundaries") == sources.boundaries else {}
    redo = [y for y in sources.years if made.get(str(y)) != states[str(y)]]
    if not redo:
        return []
    table = _population_of(spark, sources, redo).select("region", "pop_year", "population")
    kept = [y for y in sources.years if y not in redo]
    if kept:
        old = unpivot_years(spark.read.parquet(before.folder), [str(y) for y in kept])
        table = table.unionByName(old.select(*table.columns))
    commit_table(wide_population(table, sources.years), output, {"boundaries": sources.boundaries, "years": states})
    return redo


def refresh_population(
    spark: SparkSession,
    observations: str,
    area_tables: Mapping[int, str],
    dictionaries: Mapping[int, str],
    output: str,
    boundaries: str = "per_year",
    first_year: int | None = None,
    last_year: int | None = None,
) -> None:
    """Aggregate municipal counts to regions and write the wide table, all of it, as its next version.

    ``area_tables`` and ``dictionaries`` map boundary years to the area table of
    that year and to its column dictionary. Fixed boundaries take the latest one.
    """
    sources = PopulationSources(observations, area_tables, dictionaries, boundaries, first_year, last_year)
    table = _population_of(spark, sources, sources.years)
    commit_table(wide_population(table, sources.years), output, {"boundaries": boundaries, "years": _states(spark, sources)})


def write_report(report: SurveillanceReport, folder: str) -> str:
    """One Parquet table per report table, and one per chart source with a folder for each chart.

    They become the current version of ``folder`` together, once all are written;
    ``current_version`` gives its folder, which is returned.
    """
    target = new_version(folder)
    for name, df in report.tables.items():
        write_table(df, f"{target}/tables/{name}")
    for source, df in report.charts.items():
        write_table(df, f"{target}/series/{source}", partition_by=["chart"])
    facts = {"year": report.year, "modified": {name: time.isoformat() for name, time in report.modified.items()}}
    return commit(report.tables["diseases"].sparkSession, folder, target, facts).folder
