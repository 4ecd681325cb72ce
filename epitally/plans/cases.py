"""Disease cases: cleaning, classification, national counts, monthly incidence, period table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally import fixed_values as fixed
from epitally.config import Labels, SurveillanceConfig
from epitally.functions import (
    classify,
    id_prefix,
    map_region,
    not_in,
    parse_day_month_year,
    recode,
    unify_spelling,
)
from epitally.operators.filters import admitted
from epitally.operators.facts import Counted
from epitally.operators.period_table import DISEASE_STYLE, period_table
from epitally.plans.monthly import monthly_incidence


def clean_cases(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Admitted cases as ``region``, ``event_date``, ``category`` and the columns to ``keep``.

    One narrow pass. Leaving out diseases keeps rows without a disease, because
    some of them get one from their diagnosis afterwards.
    """
    disease = recode(F.col("disease"), fixed.DISEASE_RECODES)
    diagnosis = unify_spelling(F.col("summary_diagnosis"), fixed.DIAGNOSIS_PATTERN, fixed.DIAGNOSIS_REPLACEMENT, fixed.DIAGNOSIS_HEAD)
    classified = (
        raw.filter(not_in(F.col("disease"), fixed.EXCLUDED_DISEASES))
        .withColumns({"disease": disease, "summary_diagnosis": diagnosis})
        .withColumn("category", classify(fixed.DISEASE_RULES, F.col("disease")))
    )
    admission = admitted(
        F.col("confidence"),
        F.col("date_deleted"),
        F.col("status"),
        F.col("category"),
        confidences=fixed.ADMITTED_CONFIDENCE,
        statuses=fixed.ADMITTED_STATUS,
        exempt_categories=fixed.STATUS_EXEMPT_DISEASES,
        blocked_statuses=fixed.BLOCKED_STATUS,
    )
    # Plain columns decide first, so that most rows to drop are dropped before they are classified.
    return classified.filter(admission & F.col("category").isNotNull()).select(
        map_region(id_prefix(F.col("case_identifier")), fixed.REGION_BY_PREFIX).alias("region"),
        parse_day_month_year(F.col("time_entered")).alias("event_date"),
        "category",
        *keep,
    )


def first_link(link: DataFrame) -> DataFrame:
    """One local name per national name: the first one listed, by ``list_order`` of the link."""
    return first_match(link.filter(F.col("national_name").isNotNull()), "national_name", "local_name", "list_order")


def first_match(link: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Value of the lowest ``order`` per key, as a partial aggregate instead of a sort."""
    return link.groupBy(key).agg(F.min_by(F.struct(value), order).alias("_first")).select(key, f"_first.{value}")


def harmonise_names(national: DataFrame, first_per_name: DataFrame, by: str = "category") -> DataFrame:
    """Local name where the link has one, the national name elsewhere; ``n`` summed per name."""
    link = first_per_name.withColumn("_linked", F.lit(True))
    name = F.when(F.col("_linked"), F.col("local_name")).otherwise(F.col("national_name"))
    return (
        national.join(link, "national_name", "left")
        .groupBy(name.alias(by))
        .agg(F.sum("n").alias("n"))
    )


def national_incidence(
    national: DataFrame, population: DataFrame, year: int, labels: Labels | None = None
) -> DataFrame:
    """Attach the nation's population of the report year."""
    labels = labels or Labels()
    nation = population.filter((F.col("region") == labels.national) & (F.col("year") == year))
    return national.withColumn("population", nation.select("population").scalar())


def disease_monthly(
    counts: Counted, population: DataFrame, link: DataFrame, regions: Sequence[str], labels: Labels | None = None
) -> DataFrame:
    """Monthly incidence of every disease in the link table, seen or not."""
    diseases = link.select(F.col("local_name").alias("category"))
    return monthly_incidence(counts.frame, ["category"], population, regions, diseases, labels, counts.facts)


def disease_table(
    monthly: DataFrame, national: DataFrame, config: SurveillanceConfig, year: int
) -> DataFrame:
    return period_table(
        monthly,
        "category",
        config.report,
        year,
        config.regions,
        DISEASE_STYLE,
        national=national,
        exclude=fixed.DISEASES_OUTSIDE_TABLE,
        labels=config.labels,
    )
