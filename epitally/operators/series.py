"""Month series for charts: each region beside the supra-region."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from epitally.config import Labels
from epitally.functions import axis_label, is_in, not_in
from epitally.operators.checks import CoverageError
from epitally.operators.rates import summed_incidence


@dataclass(frozen=True)
class SeriesSpec:
    """Which rows of a monthly table make up one chart."""

    name: str
    source: str
    include: tuple[str, ...] | None = None
    exclude: tuple[str, ...] = ()
    breakdown: tuple[str, tuple[str, ...]] | None = None
    years: tuple[int, ...] | None = None


def _requested_rows(monthly: DataFrame, by: str, specs: Sequence[SeriesSpec]) -> list[Row]:
    """Which requested values occur together, per year; everything else is left out.

    At most as many rows as there are requested combinations and years come back.
    """
    requested: dict[str, set[str]] = {by: set()}
    for spec in specs:
        requested[by] |= {*spec.exclude, *(spec.include or ())}
        if spec.breakdown is not None:
            requested.setdefault(spec.breakdown[0], set()).update(spec.breakdown[1])
    hits = {col: F.col(col).isin(*sorted(values)) for col, values in requested.items() if values}
    if not hits:
        return []
    picked = [F.when(hit, F.col(col)).alias(col) for col, hit in hits.items()]
    return monthly.filter(reduce(or_, hits.values())).select("year", *picked).distinct().collect()


def _missing(spec: SeriesSpec, by: str, found: Sequence[Row]) -> list[str]:
    """Values the series asks for that do not occur where it looks for them."""

    def absent(col: str, values: Sequence[str]) -> list[str]:
        seen = {row[col] for row in found} if values else set()
        return [value for value in values if value not in seen]

    found = [row for row in found if spec.years is None or row["year"] in spec.years]
    missing = absent(by, spec.exclude)
    if spec.exclude:
        found = [row for row in found if row[by] not in spec.exclude]
    if spec.include is not None:
        missing += absent(by, spec.include)
        found = [row for row in found if row[by] in spec.include]
    if spec.breakdown is not None:
        missing += absent(*spec.breakdown)
    return missing


def missing_values(monthly: DataFrame, by: str, specs: Sequence[SeriesSpec]) -> dict[str, list[str]]:
    """For each series the values it asks for that do not occur, from one job for all of them.

    A value has to occur in the years of its series, and a breakdown value among
    the included rows.
    """
    found = _requested_rows(monthly, by, specs)
    return {spec.name: _missing(spec, by, found) for spec in specs}


def require_values(monthly: DataFrame, by: str, specs: Sequence[SeriesSpec]) -> None:
    """Raise when a series asks for a value that does not occur."""
    for name, missing in missing_values(monthly, by, specs).items():
        if missing:
            raise CoverageError(f"series {name}: no such value: {', '.join(missing)}")


def row_filter(by: str, spec: SeriesSpec) -> Column:
    """Whether a row belongs to a series."""
    tests = [F.lit(True)]
    if spec.years is not None:
        tests.append(is_in(F.col("year"), spec.years))
    if spec.exclude:
        tests.append(not_in(F.col(by), spec.exclude))
    if spec.include is not None:
        tests.append(is_in(F.col(by), spec.include))
    if spec.breakdown is not None:
        column, values = spec.breakdown
        tests.append(is_in(F.col(column), values))
    return reduce(and_, tests)


def select_rows(monthly: DataFrame, by: str, spec: SeriesSpec) -> DataFrame:
    """The rows of a series."""
    return monthly.filter(row_filter(by, spec))


def _points(rows: DataFrame, keys: Sequence[str], labels: Labels) -> DataFrame:
    points = rows.groupBy("region", "month_start", *keys).agg(F.sum("n").alias("n"), summed_incidence().alias("incidence"))
    is_all = is_in(F.col("region"), [labels.all_regions])
    month = Window.partitionBy("month_start", *keys)
    return (
        points.withColumn("incidence_all", F.max(F.when(is_all, F.col("incidence"))).over(month))
        .filter(~is_all)
        .withColumn("axis_label", axis_label(F.col("month_start")))
    )


def series(monthly: DataFrame, by: str, spec: SeriesSpec, labels: Labels | None = None) -> DataFrame:
    """One point per region and month, with the supra-region's incidence of that month."""
    return _points(select_rows(monthly, by, spec), [], labels or Labels())


def all_series(monthly: DataFrame, by: str, specs: Sequence[SeriesSpec], labels: Labels | None = None) -> DataFrame:
    """The points of several series, told apart by ``chart``.

    Every row is tagged with the charts it belongs to, so the monthly table is read and shuffled once for all.
    """
    charts = F.array_compact(F.array(*(F.when(row_filter(by, spec), F.lit(spec.name)) for spec in specs)))
    return _points(monthly.withColumn("chart", F.explode(charts)), ["chart"], labels or Labels())


def rename_all_regions(df: DataFrame, name: str, labels: Labels | None = None) -> DataFrame:
    """Show the supra-region under its own name."""
    labels = labels or Labels()
    shown = F.when(F.col("region") == labels.all_regions, F.lit(name)).otherwise(F.col("region"))
    return df.withColumn("region", shown)

