"""From events to dense monthly counts.

Only ``monthly_counts`` sees events. It is the single large shuffle: a partial
aggregate on every executor first reduces the events of a task to one row per
month, region and category, so a key that holds a third of all rows costs no
more to move than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.config import Labels
from epitally.functions import is_in, month_start
from epitally.operators.facts import CountFacts

_DEFAULT_LABELS = Labels()


def monthly_counts(events: DataFrame, by: Sequence[str], date_col: str = "event_date") -> DataFrame:
    """Events per region, month and category columns ``by``; undated events drop out.

    They drop out as a group without counted dates. Filtering the events instead
    would parse every date twice, once for the filter and once for the month.
    """
    return (
        events.withColumn("month_start", month_start(F.col(date_col)))
        .groupBy("region", "month_start", *by)
        .agg(F.count("month_start").alias("n"))
        .filter(F.col("n") > 0)
    )


def _axes(counts: DataFrame, regions: Sequence[str], labels: Labels) -> tuple[list[str | None], list[date]]:
    """The regions and months that a template covers.

    Months run from January of each year that occurs up to the latest month in
    the data. Regions are the listed ones, then NULL and the label of all others
    where such occur. One row of bounded size comes back, whatever is written in
    the region column.
    """
    region, listed = F.col("region"), list(regions)
    known = is_in(region, listed)
    facts = counts.agg(
        F.collect_set(F.year("month_start")).alias("years"),
        F.max("month_start").alias("latest"),
        F.max(region.isNull()).alias("none"),
        F.max(region.isNotNull() & ~known).alias("other"),
    ).first()
    months = [date(year, month, 1) for year in sorted(facts.years) for month in range(1, 13)]
    axis = [*listed, *([None] if facts.none else []), *([labels.other_regions] if facts.other else [])]
    return axis, [m for m in months if m <= facts.latest]


def on_axis(df: DataFrame, regions: Sequence[str], labels: Labels = _DEFAULT_LABELS) -> DataFrame:
    """Regions outside the list under one label, so that their events still count in the supra-region."""
    region = F.col("region")
    return df.withColumn("region", F.when(is_in(region, [*regions, None]), region).otherwise(F.lit(labels.other_regions)))


def dense_template(
    counts: DataFrame,
    by: Sequence[str],
    regions: Sequence[str],
    categories: DataFrame | None = None,
    labels: Labels = _DEFAULT_LABELS,
    facts: CountFacts | None = None,
) -> DataFrame:
    """Every region x month x category, once.

    ``categories`` lists the category values (several columns: the combinations)
    to cover; by default those that occur. They stay a distributed table, reduced
    in each task before they move, and each of its rows unfolds the region and
    month lists in place, so nothing is cross joined. NULL is a value like any
    other here. Without ``facts``, ``counts`` should be a written table; its axes are fetched.
    """
    axis, months = _axes(counts, regions, labels) if facts is None else facts.axes(labels)
    values = (counts if categories is None else categories).select(*by).distinct()
    if not axis or not months:
        values = values.limit(0)
    region_list = F.array(*(F.lit(r).cast("string") for r in axis)) if axis else F.array(F.lit(None).cast("string"))
    month_list = F.array(*map(F.lit, months)) if months else F.array(F.lit(None).cast("date"))
    spread = values.select(F.explode(region_list).alias("region"), *by).repartition("region", *by)
    return spread.select("region", F.explode(month_list).alias("month_start"), *by)


def zero_filled(
    counts: DataFrame,
    by: Sequence[str],
    regions: Sequence[str],
    categories: DataFrame | None = None,
    labels: Labels = _DEFAULT_LABELS,
    facts: CountFacts | None = None,
) -> DataFrame:
    """The counts together with a zero for every cell of the template.

    A cell may show up twice; summing settles that. Stacking instead of joining
    matches NULL keys by itself and lets the next aggregation be the only shuffle.
    """
    domain = None if categories is None else categories.select(*by).distinct()
    # The axes come from all counts, also from those outside ``categories``.
    zeros = dense_template(counts, by, regions, domain, labels, facts).withColumn("n", F.lit(0).cast("long"))
    counts = on_axis(counts, regions, labels)
    if domain is not None:
        named = domain.select(*(F.col(c).alias(f"_{c}") for c in by))
        counts = counts.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left_semi")
    return zeros.unionByName(counts.select(*zeros.columns))


def dense_counts(
    counts: DataFrame,
    by: Sequence[str],
    regions: Sequence[str],
    categories: DataFrame | None = None,
    labels: Labels = _DEFAULT_LABELS,
    facts: CountFacts | None = None,
) -> DataFrame:
    """Counts with a row, possibly zero, for every region x month x category."""
    filled = zero_filled(counts, by, regions, categories, labels, facts)
    return filled.groupBy("region", "month_start", *by).agg(F.sum("n").alias("n"))


def with_all_regions(df: DataFrame, by: Sequence[str], labels: Labels = _DEFAULT_LABELS) -> DataFrame:
    """Sums per cell, plus the same cells over all regions under their own label.

    ``grouping`` tells the total from events whose region is NULL; the latter
    count in the total and keep a row of their own.
    """
    keys = ["month_start", *by]
    return (
        df.groupingSets([["region", *keys], keys], "region", *keys)
        .agg(F.sum("n").alias("n"), F.grouping("region").alias("_all"))
        .select(
            F.when(F.col("_all") == 1, F.lit(labels.all_regions)).otherwise(F.col("region")).alias("region"),
            *keys,
            "n",
        )
    )
