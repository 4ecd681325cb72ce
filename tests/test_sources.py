import datetime as dt

import pytest
from pyspark.sql import functions as F

from epitally.operators.population import pivot_population, population_by_region, unpivot_years, with_period_parts
from epitally.plans.denominators import population_from_wide, population_table, wide_population
from epitally.plans.inputs import read_wide_population, refresh_population
from epitally.sources import (
    add_labels,
    detect_separator,
    first_column_like,
    normalize_columns,
    period_codes,
    read_area_map,
    read_events,
    read_population,
    resolve_region_columns,
    source_modified,
    write_table,
)
from epitally.sources import schemas
from epitally.sources.dimensions import RegionColumns
from epitally.sources.schemas import InputColumn
from epitally.sources.versions import read_table
from helpers import rows


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


SMALL = (InputColumn("Broad.Topic", "topic"), InputColumn("Count", "n", "bigint"), InputColumn("Rate", "rate", "double"))


def test_reads_by_name_whatever_the_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Rate,Other,Broad  Topic,Count\n1.5,z,"a, ""b""",3\nbad,z,,x\n')
    assert rows(read_events(spark, path, SMALL)) == sorted([('a, "b"', 3, 1.5), (None, None, None)], key=repr)


def test_semicolons_and_decimal_commas(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Broad Topic;Count;Rate\na,b;1.234;0,5\n")
    assert detect_separator(spark, path) == ";"
    assert rows(read_events(spark, path, SMALL)) == [("a,b", 1234, 0.5)]


def test_only_the_columns_asked_for_are_parsed(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Broad Topic,Count,Rate,Other\na,1,2.5,z\n")
    plan = read_events(spark, path, SMALL).select("n")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Count:string>" in plan


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Broad Topic,Count,Rate\n"a\nb",1,2.5\n')
    assert rows(read_events(spark, path, SMALL, multi_line=True)) == [("a\nb", 1, 2.5)]


def test_line_breaks_are_read_unless_excluded_and_then_stop_the_reading(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Broad Topic,Count,Rate\n"a\nb",1,2.5\nc,2,3.5\n')
    assert rows(read_events(spark, path, SMALL)) == [("a\nb", 1, 2.5), ("c", 2, 3.5)]
    with pytest.raises(Exception, match="FAILFAST"):
        read_events(spark, path, SMALL, multi_line=False).collect()
    with pytest.raises(Exception, match="FAILFAST"):
        read_events(spark, path, SMALL[1:2], multi_line=False).collect()
    plain = write(tmp_path / "b.csv", "Broad Topic,Count,Rate\nc,2,3.5\n")
    assert rows(read_events(spark, plain, SMALL, multi_line=False)) == [("c", 2, 3.5)]


def test_files_are_read_by_their_own_header_and_separator(spark, tmp_path):
    write(tmp_path / "a.csv", "Broad Topic,Count,Rate\na,1,2.5\n")
    write(tmp_path / "b.csv", "Count,Broad Topic,Rate\n2,b,2.5\n")
    write(tmp_path / "c d.csv", "Rate;Extra;Count;Broad Topic\n0,5;x;1.003;c\n")
    assert rows(read_events(spark, str(tmp_path), SMALL)) == [("a", 1, 2.5), ("b", 2, 2.5), ("c", 1003, 0.5)]
    both = [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")]
    assert rows(read_events(spark, both, SMALL)) == [("a", 1, 2.5), ("b", 2, 2.5)]


def test_duplicated_headers_do_not_swap_columns_of_other_files(spark, tmp_path):
    write(tmp_path / "a.csv", "Name,Agent,Scenario,Agent\n1,first,s,second\n")
    write(tmp_path / "b.csv", "Scenario,Name,Agent,Agent\nt,2,other,last\n")
    schema = (InputColumn("Name", "name"), InputColumn("Agent", "agent"), InputColumn("Scenario", "scenario"))
    assert rows(read_events(spark, str(tmp_path), schema, duplicated=["Agent"])) == [("1", "first", "s"), ("2", "other", "t")]


def test_order_of_the_files(spark, tmp_path):
    write(tmp_path / "b.csv", "Broad Topic,Count,Rate\n" + "".join(f"b{i},1,2\n" for i in range(50)))
    write(tmp_path / "a.csv", "Broad Topic,Count,Rate\na,1,2\n")
    found = read_events(spark, str(tmp_path), SMALL, order="place").repartition(5).orderBy("place").collect()
    assert [r.topic for r in found] == ["a", *(f"b{i}" for i in range(50))]


def test_duplicated_header_means_its_first_column(spark, tmp_path):
    path = write(tmp_path / "s.csv", "Name,Infectious Agent,Scenario,Infectious Agent\nBZO/1,first,s,second\n")
    schema = (InputColumn("Name", "name"), InputColumn("Infectious.Agent", "agent"))
    assert rows(read_events(spark, path, schema, duplicated=["Infectious.Agent"])) == [("BZO/1", "first")]
    df = spark.createDataFrame([(1, 2, 3)], "`Agent.1` int, other int, `Agent.9` int")
    assert first_column_like(df, "Agent").columns == ["Agent", "other"]
    with pytest.raises(ValueError):
        first_column_like(df, "Nope")


def test_parquet_and_modification_time(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.createDataFrame([("a", 1, 2.5)], "`Broad Topic` string, Count long, Rate double")
    before = dt.datetime.now() - dt.timedelta(seconds=5)
    write_table(df.toDF("Broad_Topic", "Count", "Rate").withColumnRenamed("Broad_Topic", "Broad.Topic"), path)
    assert rows(read_events(spark, path, SMALL)) == [("a", 1, 2.5)]
    assert source_modified(spark, path) >= before
    write_table(df.select("Count", "Rate"), path, partition_by=["Count"])
    assert spark.read.parquet(path).filter("Count = 1").count() == 1


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a \t b` int, c int")
    assert normalize_columns(df).columns == ["a.b", "c"]


DICTIONARY = [
    (0, None, "Dimension", "RegioS", "Regio's", 0),
    (21, 5, "TopicGroup", "", "GGD-regio's", None),
    (22, 21, "Topic", "Code_14", "Code", 14),
    (23, 21, "Topic", "Naam_15", "Naam", 15),
    (24, 5, "TopicGroup", "", "Jeugdregio's", None),
    (25, 24, "Topic", "Code_16", "Code", 16),
    (26, 24, "Topic", "Naam_17", "Naam", 17),
]


def test_region_columns_come_from_the_dictionary(spark):
    df = spark.createDataFrame(DICTIONARY, "ID int, ParentID int, Type string, Key string, Title string, Position int")
    assert resolve_region_columns(df) == RegionColumns("Code_14", "Naam_15")
    assert resolve_region_columns(df, "Jeugdregio's") == RegionColumns("Code_16", "Naam_17")
    with pytest.raises(ValueError):
        resolve_region_columns(df, "Provincies")


def test_area_map_of_several_years(spark, tmp_path):
    header = "Code_1,Naam_2,Code_14,Naam_15,Code_16,Naam_17\n"
    first = write(tmp_path / "m16.csv", header + '"GM01    ",One,GG1," Region A ",J1,Youth\n')
    second = write(tmp_path / "m17.csv", header + "GM02,Two,J9,Youth,GG2,Region B\n")
    columns = {2016: RegionColumns("Code_14", "Naam_15"), 2017: RegionColumns("Code_16", "Naam_17")}
    found = read_area_map(spark, {2017: second, 2016: first}, columns)
    assert rows(found) == [(2016, "GM01", "One", "GG1", "Region A"), (2017, "GM02", "Two", "GG2", "Region B")]
    with pytest.raises(ValueError):
        read_area_map(spark, {}, columns)


def test_municipal_population_is_limited_at_the_scan(spark, tmp_path):
    path = write(
        tmp_path / "p.csv",
        "RegioS,Perioden,BevolkingAanHetBeginVanDePeriode_1,Overledenen_3\n"
        "GM01      ,2016MM01,10,1\nGM01      ,2016MM02,11,1\nGM01      ,2017MM01,12,1\n",
    )
    df = read_population(spark, path, period_codes(2016, 2017))
    assert rows(df) == [("GM01", "2016MM01", 10), ("GM01", "2017MM01", 12)]
    assert "In(Perioden, [2016MM01,2017MM01])" in df._jdf.queryExecution().executedPlan().toString()
    assert period_codes(2014, 2016) == ["2014MM01", "2015MM01", "2016MM01"]


def test_period_parts(spark):
    df = spark.createDataFrame([("2016MM07",), ("2016JJ00",), ("x",), (None,)], "period_code string")
    assert rows(with_period_parts(df), "pop_year", "month", "granularity") == sorted(
        [(2016, 7, "month"), (2016, None, "year"), (None, None, None), (None, None, None)], key=repr
    )


def test_labels(spark):
    dim = spark.createDataFrame([("GM01      ", "One")], "Key string, Title string")
    df = spark.createDataFrame([("GM01",), ("GM02  ",), (None,)], "place string")
    assert rows(add_labels(df, dim, "place")) == sorted([("GM01", "One"), ("GM02  ", None), (None, None)], key=repr)


# Population by region

AREAS = [
    (2016, "GM01", "GGD A"),
    (2016, "GM02", "GGD B"),
    (2016, "GM03", "GGD Other"),
    (2017, "GM01", "GGD A"),
    (2017, "GM02", "GGD A"),
    (2017, "GM04", "GGD B"),
]
OBSERVED = [
    ("GM01   ", "2016MM01", 10),
    ("GM01   ", "2016JJ00", 999),
    ("GM02   ", "2016MM01", 20),
    ("GM03   ", "2016MM01", 40),
    ("GM04   ", "2016MM01", 80),
    ("GM01   ", "2017MM01", 11),
    ("GM02   ", "2017MM01", None),
    ("GM04   ", "2017MM01", 81),
    ("GM01   ", "2018MM01", 12),
    ("NL01   ", "2016MM01", 1000),
    ("NL01   ", "2017MM01", 1001),
    ("NL01   ", "2018MM01", 1002),
]
NAMES = {"GGD A": "A", "GGD B": "B"}


@pytest.fixture
def area_map(spark):
    return spark.createDataFrame(AREAS, "boundary_year int, municipality string, region_name string")


@pytest.fixture
def observations(spark):
    return spark.createDataFrame(OBSERVED, "municipality string, period_code string, population long")


def test_boundaries_per_year(spark, area_map, observations):
    found = population_table(observations, area_map, region_names=NAMES)
    assert rows(found) == sorted(
        [
            ("A", 2016, 10, 2017),
            ("B", 2016, 20, 2017),
            ("ALL_REGIONS", 2016, 30, 2017),
            # One municipality of A is unknown.
            ("A", 2017, None, 2018),
            ("B", 2017, 81, 2018),
            ("ALL_REGIONS", 2017, None, 2018),
            ("NATIONAL", 2016, 1000, 2017),
            ("NATIONAL", 2017, 1001, 2018),
        ],
        key=repr,
    )


def test_fixed_boundaries(spark, area_map, observations):
    found = population_table(observations, area_map, "fixed", boundary_year=2017, region_names=NAMES)
    wide = {r.region: tuple(r)[1:] for r in wide_population(found, [2016, 2017, 2018]).collect()}
    assert wide == {
        "A": (30, 11, 12),
        "B": (80, 81, None),
        "ALL_REGIONS": (110, 92, 12),
        "NATIONAL": (1000, 1001, 1002),
    }


def test_boundary_arguments(area_map, observations):
    with pytest.raises(ValueError):
        population_by_region(observations, area_map, NAMES, "fixed")
    with pytest.raises(ValueError):
        population_by_region(observations, area_map, NAMES, "other")


def test_wide_population_to_long(spark):
    wide = spark.createDataFrame(
        [("A", 1.0, None), ("Regio", 5.0, 6.0), ("Nederland", 9.0, 9.5)], "region string, `2020` double, `2021` double"
    )
    assert rows(population_from_wide(wide), "region", "pop_year", "population", "year") == sorted(
        [
            ("A", 2020, 1, 2021),
            ("A", 2021, None, 2022),
            ("ALL_REGIONS", 2020, 5, 2021),
            ("ALL_REGIONS", 2021, 6, 2022),
            ("NATIONAL", 2020, 9, 2021),
            ("NATIONAL", 2021, 9, 2022),
        ],
        key=repr,
    )


def test_long_to_wide_and_back(spark):
    long = spark.createDataFrame([("A", 2020, 1), ("A", 2021, 2)], "region string, pop_year int, population long")
    wide = pivot_population(long, [2020, 2021])
    assert rows(unpivot_years(wide).drop("year")) == [("A", 2020, 1), ("A", 2021, 2)]


def test_schemas_name_each_column_once():
    for schema in (schemas.CASES, schemas.SITUATIONS, schemas.ENQUIRIES, schemas.NATIONAL, schemas.NAME_LINK):
        assert len({c.name for c in schema}) == len(schema) == len({c.header for c in schema})


def test_null_population_sum(spark, area_map, observations):
    found = population_by_region(observations.withColumn("population", F.lit(None).cast("long")), area_map, NAMES, "fixed", 2017)
    assert {r.population for r in found.collect()} == {0}


def test_population_is_refreshed_from_exported_tables(spark, tmp_path):
    dictionary = "ID,Position,ParentID,Type,Key,Title,Description\n" + "".join(
        f'{i},{"" if pos is None else pos},{"" if parent is None else parent},{kind},{key},"{title}","two\nlines"\n'
        for i, parent, kind, key, title, pos in DICTIONARY
    )
    words = write(tmp_path / "dictionary.csv", dictionary)
    areas = {
        year: write(
            tmp_path / f"areas{year}.csv",
            "Code_1,Naam_2,Code_14,Naam_15,Code_16,Naam_17\n"
            f'"GM01    ",One,GG1,"{first} ",J1,Youth\n"GM02    ",Two,GG2,GGD Zeeland,J1,Youth\n',
        )
        for year, first in ((2016, "GGD West-Brabant"), (2017, "GGD Zeeland"))
    }
    observed = write(
        tmp_path / "observed.csv",
        "RegioS,Perioden,BevolkingAanHetBeginVanDePeriode_1\n"
        + "".join(
            f"{code:10},{year}{part},{n + year}\n"
            for code, n in (("GM01", 1000), ("GM02", 2000), ("NL01", 9000))
            for year in (2016, 2017)
            for part in ("MM01", "MM02")
        ),
    )
    per_year, fixed_boundaries = str(tmp_path / "per_year.parquet"), str(tmp_path / "fixed.parquet")
    refresh_population(spark, observed, areas, dict.fromkeys(areas, words), per_year)
    refresh_population(spark, observed, areas, dict.fromkeys(areas, words), fixed_boundaries, "fixed")
    assert rows(read_wide_population(spark, per_year), "region", "pop_year", "population") == sorted(
        [
            ("WB", 2016, 3016),
            ("WB", 2017, None),
            ("Zee", 2016, 4016),
            ("Zee", 2017, 7034),
            ("ALL_REGIONS", 2016, 7032),
            ("ALL_REGIONS", 2017, 7034),
            ("NATIONAL", 2016, 11016),
            ("NATIONAL", 2017, 11017),
        ],
        key=repr,
    )
    assert rows(read_table(spark, fixed_boundaries)) == sorted(
        [("Zee", 7032, 7034), ("ALL_REGIONS", 7032, 7034), ("NATIONAL", 11016, 11017)], key=repr
    )
