"""Facts that come with the write of counts, against jobs that ask the counts."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.operators.checks import coverage_flags, require_coverage
from epitally.operators.counts import _axes, dense_counts
from epitally.operators.facts import CountFacts, write_counts
from epitally.operators.filters import report_year, window_counts
from helpers import rows

REGIONS = ("A", "B")


def counts_of(spark, data):
    return spark.createDataFrame(data, "region string, month_start date, category string, n long")


def some(seed, size=25):
    rng = random.Random(seed)
    return [(rng.choice(["A", "B", "C", None]), date(rng.randrange(2019, 2024), rng.randrange(1, 13), 1), rng.choice("xy"), 1) for _ in range(size)]


@pytest.mark.parametrize("data", [some(1), some(2), some(3, 2), [("Z", date(2020, 12, 1), "x", 1)], []], ids=["many", "more", "two", "one", "none"])
@pytest.mark.parametrize("kind", [1, 4, 5])
def test_facts_are_what_the_counts_say(spark, data, kind):
    report, labels = Report(kind), Labels()
    written = write_counts(counts_of(spark, data), "facts", REGIONS)["facts"].window(report)
    plain = window_counts(counts_of(spark, data), report)
    assert rows(written.frame) == rows(plain)
    assert written.facts.year == report_year(plain)
    assert written.facts.coverage(report, 2021) == coverage_flags(plain, report, 2021).first().asDict()
    if data and plain.count():
        assert written.facts.axes(labels) == _axes(plain, REGIONS, labels)


def test_parts_have_their_own_facts(spark):
    data = [("A", date(2020, 1, 1), "x", 1), ("C", date(2021, 5, 1), "y", 2), (None, date(2022, 7, 1), None, 3)]
    parts = {"x": F.col("category") == "x", "all": F.lit(True), "none": F.lit(False)}
    written = write_counts(counts_of(spark, data), "parts", REGIONS, parts)
    assert written["x"].facts == CountFacts(frozenset({(date(2020, 1, 1), "listed")}), REGIONS)
    assert {kind for _, kind in written["all"].facts.cells} == {"listed", "other", "none"}
    assert written["none"].facts.year is None and written["none"].frame.count() == 0
    assert written["x"].frame.count() == 1 and written["all"].frame.count() == 3


def test_no_job_but_the_write(spark):
    spark.sparkContext.setJobGroup("facts", "")
    found = write_counts(counts_of(spark, some(4)).coalesce(1), "jobs", REGIONS)["jobs"].window(Report(2))
    require_coverage(found.facts, "cases", Report(5), found.facts.year)
    dense_counts(found.frame, ["category"], REGIONS, facts=found.facts)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("facts")) == 1
