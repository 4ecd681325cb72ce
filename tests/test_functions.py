import pytest
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.functions import (
    axis_label,
    classify,
    decimal_comma,
    id_prefix,
    in_period,
    incidence,
    is_in,
    map_region,
    mask_zero,
    month_start,
    not_in,
    null_propagating_sum,
    parse_day_month_year,
    parse_leading_date,
    period_label,
    recode,
    round_half_away,
    sum_or_zero,
    unify_spelling,
    with_date_parts,
)
from helpers import day


def values(spark, kind, items, expr):
    schema = f"i int, x {kind}"
    df = spark.createDataFrame(list(enumerate(items)), schema)
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_membership_treats_null_as_an_ordinary_value(spark):
    items = ["a", "b", None]
    assert values(spark, "string", items, lambda x: is_in(x, ["a"])) == [True, False, False]
    assert values(spark, "string", items, lambda x: not_in(x, ["a"])) == [False, True, True]
    assert values(spark, "string", items, lambda x: ~is_in(x, ["a"])) == [False, True, True]
    # None in the list is a listed value.
    assert values(spark, "string", items, lambda x: is_in(x, ["a", None])) == [True, False, True]
    assert values(spark, "string", items, lambda x: not_in(x, ["a", None])) == [False, True, False]
    assert values(spark, "string", items, lambda x: is_in(x, [None])) == [False, False, True]
    assert values(spark, "string", items, lambda x: not_in(x, [])) == [True, True, True]


def test_membership_reaches_the_parquet_reader(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([("a",), (None,)], "x string").write.parquet(path)
    df = spark.read.parquet(path).filter(not_in(F.col("x"), ["a"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(x),Not(" in plan
    assert df.count() == 1


def test_recode_keeps_what_it_does_not_know(spark):
    assert values(spark, "string", ["a", "b", None], lambda x: recode(x, {"a": "A"})) == ["A", "b", None]
    assert values(spark, "string", ["a"], lambda x: recode(x, {})) == ["a"]


def test_recode_does_not_chain(spark):
    assert values(spark, "string", ["a", "b"], lambda x: recode(x, {"a": "b", "b": "c"})) == ["b", "c"]


def test_map_region_keeps_or_drops_unknown_names(spark):
    names = ["WBT", "XXX", None]
    assert values(spark, "string", names, lambda x: map_region(x, {"WBT": "WB"})) == ["WB", "XXX", None]
    assert values(spark, "string", names, lambda x: map_region(x, {"WBT": "WB"}, default=None)) == ["WB", None, None]
    with pytest.raises(ValueError):
        map_region(F.col("x"), {}, default="other")


def test_classify_takes_the_first_match(spark):
    df = spark.createDataFrame(
        [("a", "p", "old"), ("b", "p", "old"), (None, None, "old"), (None, "p", None), (None, None, None)],
        "u string, v string, w string",
    )
    rules = (("u", ("a",), "first"), ("v", ("p",), "second"))
    found = [r[0] for r in df.select(classify(rules, F.col("w"))).collect()]
    assert found == ["first", "second", "old", "second", None]


def test_unify_spelling(spark):
    items = ["Scabiës", "ScabiXs crustosa", "Scabies", "other", None]
    expected = ["Scabies", "Scabies crustosa", "Scabies", "other", None]
    assert values(spark, "string", items, lambda x: unify_spelling(x, "Scabi.s", "Scabies")) == expected
    assert values(spark, "string", items, lambda x: unify_spelling(x, "Scabi.s", "Scabies", "Scabi")) == expected
    patterns = ("[Ss]cabi.s", "^Scabi.s", "(?i)scabi.s", "Sc(a|b)bi.s")
    assert all(values(spark, "string", items, lambda x, p=p: unify_spelling(x, p, "Scabies")) == expected for p in patterns)


def test_id_prefix(spark):
    assert values(spark, "string", ["BZO/1/2", "BZO", "/1", None], id_prefix) == ["BZO", "BZO", "", None]


def test_decimal_comma(spark):
    items = ["1.234,5", " 12 ", "-0,5", "x", None]
    assert values(spark, "string", items, decimal_comma) == [1234.5, 12.0, -0.5, None, None]
    assert values(spark, "string", ["1.234"], lambda x: decimal_comma(x, "bigint")) == [1234]
    assert values(spark, "string", ["1.234,0", "1,5", "12", "x"], lambda x: decimal_comma(x, "bigint")) == [1234, None, 12, None]


DAY_MONTH_YEAR = {
    "01/02/2020": "2020-02-01",
    "1-2-2020": "2020-02-01",
    "01.02.2020": "2020-02-01",
    " 1 2 2020 ": "2020-02-01",
    "01022020": "2020-02-01",
    "010220": "2020-02-01",
    "010299": "1999-02-01",
    "1,2,2024": "2024-02-01",
    "1 - 2 - 2024": "2024-02-01",
    "\t1-2-20\r": "2020-02-01",
    "\n01/02/2020 \t": "2020-02-01",
    "5 jan 24": "2024-01-05",
    "5jan2024": "2024-01-05",
    "5-mrt-2024": "2024-03-05",
    "5 Maart 2024": "2024-03-05",
    "31 okt 98": "1998-10-31",
    "5 xyz 2024": None,
    "5 jan": None,
    "31-02-20": None,
    "1234567": None,
    "11-": None,
    "1-2-20": "2020-02-01",
    "1-2-68": "2068-02-01",
    "1-2-69": "1969-02-01",
    "3 Jan 2020": "2020-01-03",
    "3-JAN-2020": "2020-01-03",
    "3 March 2020": "2020-03-03",
    "3 Jam 2020": None,
    "29/02/2020": "2020-02-29",
    "29/02/2021": None,
    "31/04/2020": None,
    "01/13/2020": None,
    "00/01/2020": None,
    "31022020": None,
    "2020-02-01": None,
    "01/02/2020 13:45": None,
    "soon": None,
    "": None,
    None: None,
}

LEADING = {
    "01/02/2020": "2020-02-01",
    "1/2/2020 13:45": "2020-02-01",
    "01/02/2020, by phone": "2020-02-01",
    "01/02/2020\nby phone": "2020-02-01",
    "01/02/20201": "2020-02-01",
    "31/02/2020": None,
    "1-2-2020": None,
    "2020-02-01": None,
    "on 01/02/2020": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize(("parse", "cases"), [(parse_day_month_year, DAY_MONTH_YEAR), (parse_leading_date, LEADING)])
def test_date_texts(spark, parse, cases):
    found = dict(zip(cases, values(spark, "string", list(cases), parse), strict=True))
    assert found == {text: expected and day(expected) for text, expected in cases.items()}


def test_a_short_leading_year_is_taken_literally(spark):
    assert values(spark, "string", ["1/2/20 x"], lambda x: F.year(parse_leading_date(x))) == [20]


def test_date_parts_and_labels(spark):
    df = with_date_parts(spark.createDataFrame([(day("2021-11-05"),), (None,)], "event_date date"))
    assert [tuple(r)[1:] for r in df.collect()] == [(2021, 11, 4), (None, None, None)]
    dates = [day("2021-01-31"), day("2021-12-01"), None]
    assert values(spark, "date", dates, month_start) == [day("2021-01-01"), day("2021-12-01"), None]
    assert values(spark, "date", dates, lambda x: period_label(x, Report(1))) == ["2021_Q1", "2021_Q4", None]
    assert values(spark, "date", dates, lambda x: period_label(x, Report(5))) == ["2021", "2021", None]
    assert values(spark, "date", dates, axis_label) == ["Jan\n2021", "Dec", None]


@pytest.mark.parametrize(
    ("kind", "end"),
    [(1, "2021-04-01"), (2, "2021-07-01"), (3, "2021-10-01"), (4, "2022-01-01"), (5, "2022-01-01")],
)
def test_window_end(kind, end):
    assert Report(kind).window_end(day("2021-05-17")) == day(end)


def test_in_period(spark):
    dates = [day("2021-03-31"), day("2021-04-01"), day("2021-06-30"), day("2021-07-01"), day("2020-05-01")]
    assert values(spark, "date", dates, lambda x: in_period(x, 2021, Report(2))) == [False, True, True, False, False]
    assert values(spark, "date", dates, lambda x: in_period(x, 2021, Report(5))) == [True] * 4 + [False]


def test_report_texts():
    assert Report(3).label(2023) == "2023_Q3"
    assert Report(5).label(2023) == "2023"
    assert Report(3).comparison_label("South", 2023) == "South 2022 Q3"
    assert Report(5).comparison_label("South", 2023) == "South 2022"
    for kind in (0, 6, "1"):
        with pytest.raises(ValueError):
            Report(kind)


def test_incidence_without_population_is_null(spark):
    df = spark.createDataFrame([(3, 1500000), (3, 0), (3, None), (0, 10)], "n long, p long")
    assert [r[0] for r in df.select(incidence(F.col("n"), F.col("p"))).collect()] == [2.0, None, None, 0.0]


def test_rounding_sends_halves_away_from_zero(spark):
    items = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49, -0.2, 0.0, None]
    found = values(spark, "double", items, round_half_away)
    assert found == [1.0, -1.0, 2.0, 3.0, -3.0, 0.0, 0.0, 0.0, None]
    assert str(found[6]) == "0.0"
    # The half is added before cutting off, so the largest double below a half goes up.
    assert values(spark, "double", [0.49999999999999994], round_half_away) == [1.0]
    assert values(spark, "double", [0.25, -0.25], lambda x: round_half_away(x, 1)) == [0.3, -0.3]


def test_mask_zero(spark):
    assert values(spark, "long", [0, 1, None], mask_zero) == [None, 1, None]
    assert values(spark, "double", [0.0, 0.4], mask_zero) == [None, 0.4]


def test_the_two_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None), ("c", 2)], "k string, x long")
    found = {
        r[0]: (r[1], r[2])
        for r in df.groupBy("k").agg(sum_or_zero(F.col("x")), null_propagating_sum(F.col("x"))).collect()
    }
    assert found == {"a": (1, None), "b": (0, None), "c": (2, 2)}
