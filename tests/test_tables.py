import pytest
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.operators.period_table import DISEASE_STYLE, SITUATION_STYLE, period_table, with_total
from epitally.operators.series import SeriesSpec, rename_all_regions, require_values, select_rows, series
from epitally.operators.checks import (
    CoverageError,
    coverage_flags,
    denominator_flags,
    require_coverage,
    require_denominators,
)
from epitally.operators.topics import pivot_topics, top_topics
from helpers import day, rows, table

MILLION = 1000000


def monthly(spark, cells, by="category"):
    """Cells of (region, month, category, n); a million people everywhere, half of that in C, none known in NULL."""
    df = spark.createDataFrame(cells, f"region string, month_start date, {by} string, n long")
    people = F.when(F.col("region") == "C", F.lit(MILLION // 2)).when(F.col("region").isNotNull(), F.lit(MILLION))
    return df.withColumn("year", F.year("month_start")).withColumn("population", people.cast("long"))


def dense(cells):
    """Add the supra-region's cells."""
    totals = {}
    for _, month, category, n in cells:
        totals[(month, category)] = totals.get((month, category), 0) + n
    return cells + [("ALL_REGIONS", m, c, n) for (m, c), n in totals.items()]


CELLS = dense(
    [
        ("A", day("2021-04-01"), "x", 1),
        ("A", day("2021-06-01"), "x", 2),
        ("A", day("2021-07-01"), "x", 50),
        ("C", day("2021-05-01"), "x", 0),
        ("A", day("2021-04-01"), "y", 0),
        ("C", day("2021-04-01"), "y", 0),
        ("A", day("2020-05-01"), "x", 7),
        ("A", day("2020-05-01"), "y", 0),
        ("A", day("2020-08-01"), "x", 70),
    ]
)


def test_situation_table_masks_regions_only(spark):
    found = table(
        period_table(monthly(spark, CELLS), "category", Report(2), 2021, ["A", "C"], SITUATION_STYLE), "category"
    )
    assert list(found["x"]) == [
        "category",
        "is_total",
        "A_n",
        "C_n",
        "ALL_REGIONS_n",
        "A_incidence",
        "C_incidence",
        "ALL_REGIONS_incidence",
        "ALL_REGIONS_incidence_previous",
    ]
    assert list(found["x"].values())[1:] == [False, 3, None, 3, 3.0, None, 3.0, 7.0]
    assert list(found["y"].values())[1:] == [False, None, None, 0, None, None, 0.0, 0.0]
    assert list(found["TOTAL"].values())[1:] == [True, 3, None, 3, 3.0, None, 3.0, 7.0]


def national(spark, data):
    return spark.createDataFrame(data, "category string, n long, population long")


def test_disease_table_masks_all_but_the_nation(spark):
    nation = national(spark, [("x", 0, 17 * MILLION), ("z", 34, 17 * MILLION)])
    found = table(
        period_table(monthly(spark, CELLS), "category", Report(2), 2021, ["A", "C"], DISEASE_STYLE, national=nation),
        "category",
    )
    x, y, z, total = (list(found[k].values())[1:] for k in ("x", "y", "z", "TOTAL"))
    # is_total, A_n, C_n, ALL_n, NATIONAL_n, A, C, ALL, NATIONAL, previous
    assert x == [False, 3, None, 3, 0, 3.0, None, 3.0, 0.0, 7.0]
    assert y == [False, None, None, None, None, None, None, None, None, None]
    assert z == [False, None, None, None, 34, None, None, None, 2.0, None]
    assert total == [True, 3, None, 3, 34, 3.0, None, 3.0, 2.0, 7.0]


def test_excluded_categories_leave_rows_and_total(spark):
    cells = dense([("A", day("2021-01-01"), c, n) for c, n in (("x", 1), ("y", 10), (None, 100))])
    found = table(
        period_table(monthly(spark, cells), "category", Report(5), 2021, ["A"], DISEASE_STYLE, exclude=["y"]), "category"
    )
    assert set(found) == {"x", None, "TOTAL"}
    assert found["TOTAL"]["A_n"] == 101


def test_total_sums_before_rounding(spark):
    cells = dense([("A", day("2021-01-01"), c, 1) for c in "xyz"])
    frame = monthly(spark, cells).withColumn("population", F.lit(2500000).cast("long"))
    found = table(period_table(frame, "category", Report(5), 2021, ["A"], SITUATION_STYLE), "category")
    assert [found[c]["ALL_REGIONS_incidence"] for c in ("x", "y", "z", "TOTAL")] == [0.0, 0.0, 0.0, 1.0]
    assert found["x"]["A_incidence"] is None


def test_missing_previous_year(spark):
    cells = dense([("A", day("2021-01-01"), "x", 1)])
    column = "ALL_REGIONS_incidence_previous"
    for style in (SITUATION_STYLE, DISEASE_STYLE):
        found = table(period_table(monthly(spark, cells), "category", Report(1), 2021, ["A"], style), "category")
        assert found["x"][column] is None
        assert found["TOTAL"][column] is None


def test_category_of_last_year_only_has_no_row(spark):
    cells = dense([("A", day("2021-01-01"), "x", 1), ("A", day("2020-01-01"), "x", 2), ("A", day("2020-01-01"), "old", 9)])
    found = table(period_table(monthly(spark, cells), "category", Report(1), 2021, ["A"], DISEASE_STYLE), "category")
    assert set(found) == {"x", "TOTAL"}
    assert found["TOTAL"]["ALL_REGIONS_incidence_previous"] == 2.0


def test_regions_without_population(spark):
    cells = dense([("A", day("2021-01-01"), "x", 5)])
    frame = monthly(spark, cells).withColumn("population", F.lit(None).cast("long"))
    nation = national(spark, [("x", 5, None)])
    found = table(
        period_table(frame, "category", Report(1), 2021, ["A"], SITUATION_STYLE, rounded=False), "category"
    )
    assert (found["x"]["A_n"], found["x"]["A_incidence"]) == (5, 0.0)
    found = table(
        period_table(frame, "category", Report(1), 2021, ["A"], DISEASE_STYLE, national=nation), "category"
    )
    assert (found["x"]["NATIONAL_n"], found["x"]["NATIONAL_incidence"]) == (5, None)
    assert found["TOTAL"]["NATIONAL_incidence"] == 0.0


def test_listed_region_without_events_keeps_its_columns(spark):
    cells = dense([("A", day("2021-01-01"), "x", 5)])
    found = table(period_table(monthly(spark, cells), "category", Report(1), 2021, ["A", "B"], SITUATION_STYLE), "category")
    assert found["x"]["B_n"] is None and found["x"]["B_incidence"] is None


def test_unlisted_region_counts_in_the_supra_region(spark):
    cells = dense([("A", day("2021-01-01"), "x", 5), ("Q", day("2021-01-01"), "x", 2), (None, day("2021-01-01"), "x", 1)])
    found = table(period_table(monthly(spark, cells), "category", Report(1), 2021, ["A"], SITUATION_STYLE), "category")
    assert found["x"]["ALL_REGIONS_n"] == 8


@pytest.mark.parametrize(("skip", "expected"), [(True, (3, 0)), (False, (3, None))])
def test_total_row(spark, skip, expected):
    wide = spark.createDataFrame(
        [("x", 1, None, 5), ("y", 2, None, 5)], "category string, A_n long, B_n long, A_population long"
    ).withColumn("B_population", F.lit(None).cast("long"))
    found = with_total(wide, "category", ["A_n", "B_n"], skip)
    total = found.filter("is_total").first()
    assert (total.A_n, total.B_n) == expected
    assert found.filter("not is_total and B_n is null").count() == 2


# Top topics

TOPICS = [
    *(("A", day("2021-01-01"), t, n) for t, n in (("e", 5), ("d", 1), ("c", 1), ("b", 1), ("a", 0), ("f", 1), ("g", 9))),
    ("A", day("2021-03-01"), "e", 5),
    ("A", day("2021-04-01"), "a", 99),
    ("A", day("2020-01-01"), "a", 99),
    ("B", day("2021-01-01"), "a", 0),
    ("B", day("2021-01-01"), None, 0),
    (None, day("2021-01-01"), "a", 4),
    ("ALL_REGIONS", day("2021-01-01"), "a", 4),
]


def test_top_topics_break_ties_by_name_and_fill_with_zeros(spark):
    ranked = top_topics(monthly(spark, TOPICS, "topic"), "topic", Report(1), 2021)
    found = sorted((r.region, r["rank"], r.topic, r.n) for r in ranked.collect())
    assert found == [
        ("A", 1, "e", 10),
        ("A", 2, "g", 9),
        ("A", 3, "b", 1),
        ("A", 4, "c", 1),
        ("A", 5, "d", 1),
        ("B", 1, "a", 0),
        ("B", 2, None, 0),
    ]
    wide = table(pivot_topics(ranked, "topic", ["B", "A"]), "rank")
    assert list(wide[1]) == ["rank", "B_topic", "B_n", "A_topic", "A_n"]
    assert list(wide[1].values()) == [1, "a", 0, "e", 10]
    assert list(wide[5].values()) == [5, None, None, "d", 1]


def test_top_topics_relabel_first_and_prune_before_the_shuffle(spark):
    ranked = top_topics(monthly(spark, TOPICS, "topic"), "topic", Report(1), 2021, relabel={"g": "zz", "d": "zz"})
    assert [r.n for r in ranked.filter("topic = 'zz'").collect()] == [10]
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()


# Series

SERIES = dense(
    [
        ("A", day("2020-12-01"), "x", 1),
        ("A", day("2020-12-01"), "y", 2),
        ("A", day("2020-12-01"), None, 4),
        ("C", day("2020-12-01"), "x", 8),
        ("A", day("2021-01-01"), "x", 3),
        (None, day("2021-01-01"), "x", 5),
    ]
)


def points(df):
    return {(r.region, r.month_start.isoformat()[:7]): (r.n, r.incidence, r.incidence_all) for r in df.collect()}


def test_series_puts_the_supra_region_beside_each_region(spark):
    frame = monthly(spark, SERIES)
    assert points(series(frame, "category", SeriesSpec("all", "s"))) == {
        ("A", "2020-12"): (7, 7.0, 15.0),
        ("C", "2020-12"): (8, 16.0, 15.0),
        ("A", "2021-01"): (3, 3.0, 8.0),
        (None, "2021-01"): (5, 0.0, 8.0),
    }


def test_series_filters(spark):
    frame = monthly(spark, SERIES)
    without_x = SeriesSpec("s", "s", exclude=("x",))
    assert points(series(frame, "category", without_x)) == {("A", "2020-12"): (6, 6.0, 6.0)}
    several = SeriesSpec("s", "s", include=("x", "y"))
    assert points(series(frame, "category", several))[("A", "2020-12")] == (3, 3.0, 11.0)
    one_year = SeriesSpec("s", "s", include=("x",), years=(2021,))
    assert set(points(series(frame, "category", one_year))) == {("A", "2021-01"), (None, "2021-01")}
    labels = {r.axis_label for r in series(frame, "category", SeriesSpec("s", "s")).collect()}
    assert labels == {"Dec", "Jan\n2021"}


def test_series_breakdown(spark):
    frame = monthly(spark, SERIES).withColumn("agent", F.when(F.col("n") > 3, F.lit("p")))
    spec = SeriesSpec("s", "s", include=("x",), breakdown=("agent", ("p",)))
    assert rows(select_rows(frame, "category", spec), "region", "n") == sorted(
        [("C", 8), ("ALL_REGIONS", 9), (None, 5), ("ALL_REGIONS", 8)], key=repr
    )


def test_a_breakdown_alone_is_checked_too(spark):
    frame = monthly(spark, SERIES).withColumn("agent", F.when(F.col("n") > 3, F.lit("p")))
    require_values(frame, "category", [SeriesSpec("s", "s", breakdown=("agent", ("p",)))])
    with pytest.raises(CoverageError):
        require_values(frame, "category", [SeriesSpec("s", "s", breakdown=("agent", ("nope",)))])


@pytest.mark.parametrize(
    "spec",
    [
        SeriesSpec("s", "s", exclude=("nope",)),
        SeriesSpec("s", "s", include=("x", "nope")),
        SeriesSpec("s", "s", include=("y",), years=(2021,)),
        SeriesSpec("s", "s", include=("x",), breakdown=("agent", ("nope",))),
        SeriesSpec("s", "s", include=("y",), breakdown=("agent", ("p",))),
        SeriesSpec("s", "s", exclude=("x",), include=("x",)),
        SeriesSpec("s", "s", breakdown=("agent", ("nope",))),
    ],
)
def test_series_values_must_occur(spark, spec):
    frame = monthly(spark, SERIES).withColumn("agent", F.when(F.col("n") > 3, F.lit("p")))
    fine = SeriesSpec("fine", "s", exclude=("y",), include=("x",), breakdown=("agent", ("p",)), years=(2020, 2021))
    require_values(frame, "category", [fine, SeriesSpec("all", "s")])
    with pytest.raises(CoverageError, match="series s: no such value"):
        require_values(frame, "category", [fine, spec])


def test_rename_all_regions(spark):
    frame = monthly(spark, SERIES)
    assert {r.region for r in rename_all_regions(frame, "South").collect()} == {"A", "C", None, "South"}


# Checks


def months(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "month_start date")


def test_coverage(spark):
    df = months(spark, "2020-05-01", "2021-01-01")
    flags = coverage_flags(df, Report(1), 2021).first()
    assert flags.asDict() == {
        "first_year": 2020,
        "latest_year": 2021,
        "period_covered": True,
        "starts_in_time": True,
    }
    assert not coverage_flags(df, Report(2), 2021).first().period_covered
    assert coverage_flags(df, Report(5), 2021).first().period_covered
    assert not coverage_flags(df, Report(1), 2019).first().starts_in_time
    require_coverage(df, "cases", Report(1), 2021)
    with pytest.raises(CoverageError, match="cases: no rows in period 2"):
        require_coverage(df, "cases", Report(2), 2021)
    with pytest.raises(CoverageError, match="starts in 2020"):
        require_coverage(df, "cases", Report(1), 2019)
    with pytest.raises(CoverageError):
        require_coverage(df.limit(0), "cases", Report(5), 2021)


def test_denominators_must_reach_the_report_year(spark):
    data = [("A", 2019, 5), ("A", 2020, 5), ("B", 2020, 0), ("C", 2020, None), ("C", 2021, None)]
    people = spark.createDataFrame(data, "region string, pop_year int, population long")
    assert denominator_flags(people, 2021).first().fresh
    require_denominators(people, 2021)
    require_denominators(people, 2021, ["A", "B"])
    # A count that is not known does not serve, and every region needs one.
    for frame, year, regions in ((people, 2022, ()), (people.limit(0), 2021, ()), (people, 2021, ("A", "C")), (people, 2021, ("A", "D"))):
        with pytest.raises(CoverageError):
            require_denominators(frame, year, regions)
