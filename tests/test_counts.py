import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.functions import is_in
from epitally.operators.counts import dense_counts, dense_template, monthly_counts, with_all_regions, zero_filled
from epitally.operators.filters import admitted, at_period, report_window, report_year, window_counts
from epitally.operators.rates import drop_breakdown, to_period, with_incidence
from helpers import day, rows

EVENTS = [
    ("A", day("2020-11-05"), "x"),
    ("A", day("2020-11-30"), "x"),
    ("B", day("2020-12-01"), None),
    (None, day("2021-02-03"), "x"),
    ("A", None, "x"),
    ("B", day("2021-02-28"), "y"),
]


def events(spark, data=EVENTS):
    return spark.createDataFrame(data, "region string, event_date date, category string")


def test_monthly_counts_drop_undated_events(spark):
    assert rows(monthly_counts(events(spark), ["category"])) == sorted(
        [
            ("A", day("2020-11-01"), "x", 2),
            ("B", day("2020-12-01"), None, 1),
            (None, day("2021-02-01"), "x", 1),
            ("B", day("2021-02-01"), "y", 1),
        ],
        key=repr,
    )


def test_template_spans_whole_years_up_to_the_latest_month(spark):
    template = rows(dense_template(monthly_counts(events(spark), ["category"]), ["category"], "AB"))
    months = [day(f"2020-{m:02}-01") for m in range(1, 13)] + [day("2021-01-01"), day("2021-02-01")]
    expected = itertools.product(["A", "B", None], months, ["x", "y", None])
    assert template == sorted(expected, key=repr)


def test_template_skips_years_without_events(spark):
    data = [("A", day("2018-03-01"), "x"), ("A", day("2020-01-09"), "x")]
    template = dense_template(monthly_counts(events(spark, data), ["category"]), ["category"], "A")
    assert sorted({r.month_start.year for r in template.collect()}) == [2018, 2020]
    assert template.count() == 13


def test_dense_counts_match_null_keys(spark):
    dense = dense_counts(monthly_counts(events(spark), ["category"]), ["category"], "AB")
    assert dense.count() == 3 * 14 * 3
    found = {(r.region, r.month_start, r.category): r.n for r in dense.collect() if r.n}
    assert found == {
        ("A", day("2020-11-01"), "x"): 2,
        ("B", day("2020-12-01"), None): 1,
        (None, day("2021-02-01"), "x"): 1,
        ("B", day("2021-02-01"), "y"): 1,
    }


def test_category_domain_adds_unseen_and_drops_unlisted_values(spark):
    domain = spark.createDataFrame([("x",), ("z",), ("x",)], "category string")
    dense = dense_counts(monthly_counts(events(spark), ["category"]), ["category"], "AB", domain)
    # Region B only has unlisted categories, yet stays an axis value.
    assert dense.count() == 3 * 14 * 2
    assert {r.category: r.n for r in dense.groupBy("category").agg(F.sum("n").alias("n")).collect()} == {"x": 3, "z": 0}
    assert {r.region for r in dense.select("region").distinct().collect()} == {"A", "B", None}


def test_pairs_are_observed_pairs_not_all_combinations(spark):
    data = [("A", day("2020-01-01"), "r", "p"), ("B", day("2020-01-01"), "s", None)]
    df = spark.createDataFrame(data, "region string, event_date date, scenario string, agent string")
    dense = dense_counts(monthly_counts(df, ["scenario", "agent"]), ["scenario", "agent"], "AB")
    assert rows(dense) == sorted(
        [
            ("A", day("2020-01-01"), "r", "p", 1),
            ("B", day("2020-01-01"), "r", "p", 0),
            ("A", day("2020-01-01"), "s", None, 0),
            ("B", day("2020-01-01"), "s", None, 1),
        ],
        key=repr,
    )


def test_supra_region_counts_events_without_region(spark):
    counts = monthly_counts(events(spark), ["category"])
    rolled = with_all_regions(counts, ["category"])
    at = {(r.region, r.month_start, r.category): r.n for r in rolled.collect()}
    assert at[("ALL_REGIONS", day("2021-02-01"), "x")] == 1
    assert at[(None, day("2021-02-01"), "x")] == 1
    assert sum(n for (region, *_), n in at.items() if region == "ALL_REGIONS") == 5


def test_random_events_against_brute_force(spark):
    """A third of all rows on one key; every cell compared."""
    rng = random.Random(7)
    regions, categories = ["A", "B", "C", None], ["x", "y", "z", None]
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        region = "A" if hot else rng.choice(regions)
        month = day("2020-05-01") if hot else day(f"{rng.choice([2019, 2020])}-{rng.randint(1, 12):02}-01")
        data.append((region, month.replace(day=rng.randint(1, 28)), "x" if hot else rng.choice(categories)))
    latest = max(d for _, d, _ in data)
    counted = Counter((r, d.replace(day=1), c) for r, d, c in data)
    months = [day(f"{y}-{m:02}-01") for y in (2019, 2020) for m in range(1, 13)]
    expected = {
        (r, m, c): counted[(r, m, c)] for r in regions for m in months if m <= latest for c in categories
    }
    for (r, m, c), n in list(expected.items()):
        key = ("ALL_REGIONS", m, c)
        expected[key] = expected.get(key, 0) + n
    by = ["category"]
    rolled = with_all_regions(zero_filled(monthly_counts(events(spark, data), by), by, "ABC"), by)
    assert {(r.region, r.month_start, r.category): r.n for r in rolled.collect()} == expected


def test_unlisted_regions_are_one_region_that_still_counts(spark):
    """Malformed identifiers must not blow up the calendar, nor lose an event."""
    i = F.col("id")
    region = F.when(i % 20 == 0, F.concat(F.lit("bad "), i)).otherwise("A")
    many = spark.range(20000).select(region.alias("region"), F.lit(day("2021-03-05")).alias("event_date"), F.lit("x").alias("category"))
    dense = dense_counts(monthly_counts(many, ["category"]), ["category"], ["A", "B"])
    assert dense.count() == 3 * 3
    march = {r.region: r.n for r in dense.filter("month_start = '2021-03-01'").collect()}
    assert march == {"A": 19000, "B": 0, "OTHER_REGIONS": 1000}
    total = with_all_regions(dense, ["category"]).filter("region = 'ALL_REGIONS'").agg(F.sum("n")).first()[0]
    assert total == 20000


def test_categories_are_reduced_before_they_move(spark, tmp_path):
    path = str(tmp_path / "domain.parquet")
    spark.range(1000).select((F.col("id") % 3).cast("string").alias("category")).write.parquet(path)
    counts = monthly_counts(events(spark), ["category"])
    plan = dense_template(counts, ["category"], "AB", spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in below and "FileScan" in below
    assert "REPARTITION_BY_NUM" not in plan and "collect_set" not in plan


def test_nothing_gives_an_empty_template(spark):
    counts = monthly_counts(events(spark, []), ["category"])
    assert dense_template(counts, ["category"], "AB").count() == 0
    assert dense_counts(counts, ["category"], "AB").count() == 0


def test_a_denominator_given_twice_stops_the_job(spark):
    counts = spark.createDataFrame([("A", day("2021-01-01"), 5)], "region string, month_start date, n long")
    with pytest.raises(Exception, match="more than one row for A 2021"):
        with_incidence(counts, population(spark, [("A", 2021, 10), ("A", 2021, 10)])).collect()


def test_report_window_on_events_and_on_counts(spark):
    data = [("A", day(d), "x") for d in ("2020-12-31", "2021-03-31", "2021-04-01", "2021-08-09")]
    df = events(spark, [*data, ("A", None, "x")])
    kept = {1: 2, 2: 3, 3: 4, 4: 4, 5: 4}
    for kind, n in kept.items():
        assert report_window(df, Report(kind)).count() == n
        windowed = window_counts(monthly_counts(df, ["category"]), Report(kind))
        assert windowed.agg(F.sum("n")).first()[0] == n
    assert report_year(window_counts(monthly_counts(df, []), Report(1))) == 2021


def test_window_may_empty_the_latest_year(spark):
    df = events(spark, [("A", day("2020-02-01"), "x"), ("A", day("2021-05-01"), "x")])
    assert report_year(window_counts(monthly_counts(df, []), Report(1))) == 2020


def test_window_of_nothing(spark):
    df = events(spark, [("A", None, "x")])
    counts = monthly_counts(df, ["category"])
    assert window_counts(counts, Report(1)).count() == 0
    assert report_window(df, Report(1)).count() == 0
    assert report_year(counts) is None


def test_admission(spark):
    data = [
        (1, "Sure", None, "final", "x"),
        (2, "Sure", "1/1/2020", "final", "x"),
        (3, "Sure", None, "open", "x"),
        (4, "Sure", None, None, "x"),
        (5, "Sure", None, None, "exempt"),
        (6, "Sure", None, "blocked", "exempt"),
        (7, "Sure", None, "open", "exempt"),
        (8, None, None, "final", "x"),
        (9, "Unsure", None, "final", "exempt"),
        (10, "Sure", "1/1/2020", None, "exempt"),
    ]
    df = spark.createDataFrame(data, "id int, conf string, del string, status string, cat string")
    condition = admitted(
        F.col("conf"),
        F.col("del"),
        F.col("status"),
        F.col("cat"),
        confidences=["Sure"],
        statuses=["final"],
        exempt_categories=["exempt"],
        blocked_statuses=["blocked"],
    )
    assert [r.id for r in df.filter(condition).orderBy("id").collect()] == [1, 5, 7]


def population(spark, data):
    return spark.createDataFrame(data, "region string, year int, population long")


def test_denominators_belong_to_region_and_year(spark):
    counts = spark.createDataFrame(
        [("A", day("2020-12-01"), 2), ("A", day("2021-01-01"), 2), ("B", day("2021-01-01"), 3), (None, day("2021-01-01"), 1)],
        "region string, month_start date, n long",
    )
    people = population(spark, [("A", 2020, 1000000), ("A", 2021, 2000000), ("B", 2021, 0)])
    found = rows(with_incidence(counts, people), "region", "year", "n", "incidence")
    assert found == sorted(
        [("A", 2020, 2, 2.0), ("A", 2021, 2, 1.0), ("B", 2021, 3, None), (None, 2021, 1, None)], key=repr
    )


def test_period_sums_count_missing_rates_as_zero(spark):
    counts = spark.createDataFrame(
        [("A", day("2021-01-01"), "x", 2), ("A", day("2021-03-01"), "x", 1), ("A", day("2021-04-01"), "x", 5), ("B", day("2021-01-01"), "x", 4)],
        "region string, month_start date, category string, n long",
    )
    monthly = with_incidence(counts, population(spark, [("A", 2021, 1000000)]))
    columns = ("region", "period", "category", "n", "incidence")
    assert rows(to_period(monthly, ["category"], Report(1)), *columns) == sorted(
        [("A", "2021_Q1", "x", 3, 3.0), ("A", "2021_Q2", "x", 5, 5.0), ("B", "2021_Q1", "x", 4, 0.0)], key=repr
    )
    assert rows(to_period(monthly, ["category"], Report(5)), *columns) == sorted(
        [("A", "2021", "x", 8, 8.0), ("B", "2021", "x", 4, 0.0)], key=repr
    )
    assert at_period(monthly, 2021, Report(2)).count() == 1


def test_breakdown_exclusion_keeps_unknown_values(spark):
    counts = spark.createDataFrame(
        [("A", day("2021-01-01"), "r", "p", 2), ("A", day("2021-01-01"), "r", None, 3), ("A", day("2021-01-01"), "r", "q", 4)],
        "region string, month_start date, scenario string, agent string, n long",
    )
    monthly = with_incidence(counts, population(spark, [("A", 2021, 1000000)]))
    found = drop_breakdown(monthly, ["scenario"], "agent", ["q"])
    assert rows(found, "region", "month_start", "scenario", "n", "incidence") == [("A", day("2021-01-01"), "r", 5, 5.0)]
    assert drop_breakdown(monthly, ["scenario"], "agent").first().n == 9


def test_properties_of_dense_counts(spark):
    counts = monthly_counts(events(spark), ["category"])
    dense = dense_counts(counts, ["category"], "AB")
    rolled = with_all_regions(dense, ["category"])
    is_all = is_in(F.col("region"), ["ALL_REGIONS"])
    assert rows(dense.filter("n > 0").select(*counts.columns)) == rows(counts)
    total = rolled.groupBy(is_all.alias("a")).agg(F.sum("n").alias("n")).collect()
    assert {r.a: r.n for r in total} == {True: 5, False: 5}
