"""Wide tables of one report period: regions, supra-region, nation, a year before."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.functions import (
    in_period,
    incidence,
    mask_zero,
    not_in,
    null_propagating_sum,
    round_half_away,
    sum_or_zero,
)

_PREVIOUS = "_previous"


@dataclass(frozen=True)
class TableStyle:
    """How a table totals and which of its zeros stay blank."""

    skip_nulls: bool
    mask_all_regions: bool
    mask_previous: bool


DISEASE_STYLE = TableStyle(skip_nulls=True, mask_all_regions=True, mask_previous=True)
SITUATION_STYLE = TableStyle(skip_nulls=False, mask_all_regions=False, mask_previous=False)


def pivot_regions(df: DataFrame, keys: Sequence[str], regions: Sequence[str], column: str = "region") -> DataFrame:
    """One row per key, with ``<region>_n`` and ``<region>_population`` columns.

    The region list is given, never looked up: no extra job, and a fixed schema.
    """
    return (
        df.groupBy(*keys)
        .pivot(column, list(regions))
        .agg(F.sum("n").alias("n"), F.max("population").alias("population"))
    )


def with_total(wide: DataFrame, by: str, columns: Sequence[str], skip_nulls: bool) -> DataFrame:
    """Add a row of column sums, flagged by ``is_total``.

    Only counts are summed; populations are the same in every row. Rates are
    derived afterwards, so the total does not depend on the order of additions.
    """
    total = sum_or_zero if skip_nulls else null_propagating_sum
    populations = [c.removesuffix("_n") + "_population" for c in columns]
    is_total = F.grouping(by) == 1
    return wide.groupingSets([[by], []], by).agg(
        is_total.alias("is_total"),
        # Per category there is one row, whose NULLs have to stay.
        *(F.when(is_total, total(F.col(f"`{c}`"))).otherwise(F.max(f"`{c}`")).alias(c) for c in columns),
        *(F.max(f"`{c}`").alias(c) for c in populations),
    )


def round_and_mask(col: Column, masked: bool, digits: int = 0) -> Column:
    rounded = round_half_away(col, digits)
    return mask_zero(rounded) if masked else rounded


def period_table(
    monthly: DataFrame,
    by: str,
    report: Report,
    year: int,
    regions: Sequence[str],
    style: TableStyle,
    national: DataFrame | None = None,
    exclude: Iterable[str] = (),
    labels: Labels | None = None,
    rounded: bool = True,
) -> DataFrame:
    """Counts and incidence per category for one period, with the year before.

    ``monthly`` holds dense counts with population, supra-region included.
    ``national`` holds ``category`` (named ``by``), ``n`` and ``population``.

    The period, the same period a year before and the nation become columns of
    one pivot. That lines up the previous year by category without joining, and
    reads the monthly table once.
    """
    labels = labels or Labels()
    previous_year = year - 1
    date, region = F.col("month_start"), F.col("region")
    column = F.when(in_period(date, year, report), region).when(
        in_period(date, previous_year, report) & (region == labels.all_regions), F.lit(_PREVIOUS)
    )
    cells = (
        # Stated as date ranges as well: other months are dropped before the dense cells are shuffled.
        monthly.filter(in_period(date, year, report) | in_period(date, previous_year, report))
        .withColumn("_column", column)
        .filter(F.col("_column").isNotNull())
        .select(by, "_column", "n", "population")
    )
    columns = [*regions, labels.all_regions]
    if national is not None:
        columns.append(labels.national)
        cells = cells.unionByName(
            national.select(by, F.lit(labels.national).alias("_column"), "n", "population")
        )
    exclude = tuple(exclude)
    if exclude:
        cells = cells.filter(not_in(F.col(by), exclude))

    wide = pivot_regions(cells, [by], [*columns, _PREVIOUS], "_column")
    # A category needs a row in this period; having had one last year is not enough.
    present = [F.col(f"`{c}_n`") for c in columns if c not in regions]
    wide = wide.filter(F.coalesce(*present).isNotNull())
    table = with_total(wide, by, [f"{c}_n" for c in [*columns, _PREVIOUS]], style.skip_nulls)

    def count(name: str, masked: bool) -> Column:
        col = F.col(f"`{name}_n`")
        return (mask_zero(col) if rounded and masked else col).alias(f"{name}_n")

    def rate(name: str, masked: bool, alias: str | None = None) -> Column:
        n = F.col(f"`{name}_n`")
        value = incidence(n, F.col(f"`{name}_population`"))
        # Without a population, sums of regional rates are 0, and so is a total that skips NULL.
        is_sum = n.isNotNull() if name != labels.national else F.col("is_total") & F.lit(style.skip_nulls)
        value = F.when(is_sum, F.coalesce(value, F.lit(0.0))).otherwise(value)
        if rounded:
            value = round_and_mask(value, masked)
        return value.alias(alias or f"{name}_incidence")

    def masked(name: str) -> bool:
        return name in regions or (name == labels.all_regions and style.mask_all_regions)

    return table.select(
        F.when(F.col("is_total"), F.lit(labels.total)).otherwise(F.col(by)).alias(by),
        "is_total",
        *(count(name, masked(name)) for name in columns),
        # The nation's own rate shows its zeros.
        *(rate(name, masked(name)) for name in columns),
        rate(_PREVIOUS, style.mask_previous, f"{labels.all_regions}_incidence_previous"),
    )
