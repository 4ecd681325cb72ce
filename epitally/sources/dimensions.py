"""Population statistics: observations, area maps, dictionaries, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally import fixed_values as fixed
from epitally.sources.files import normalize_columns, read_events, read_texts
from epitally.sources.schemas import AREA_CODE_HEADER, AREA_NAME_HEADER, MUNICIPAL_POPULATION


class RegionColumns(NamedTuple):
    code: str
    name: str


def period_codes(first: int, last: int) -> list[str]:
    """Codes of the first month of each year."""
    return [f"{year}MM01" for year in range(first, last + 1)]


def read_population(
    spark: SparkSession, path: str | Sequence[str], periods: Iterable[str] | None = None
) -> DataFrame:
    """Municipal population: trimmed ``municipality``, ``period_code``, ``population``.

    The periods are tested on the untouched column so that the test reaches the scan.
    """
    observations = read_events(spark, path, MUNICIPAL_POPULATION)
    if periods is not None:
        observations = observations.filter(F.col("period_code").isin(*periods))
    return observations.withColumn("municipality", F.trim("municipality"))


def resolve_region_columns(
    dictionary: DataFrame,
    topic_group: str = fixed.REGION_TOPIC_GROUP,
    code_title: str = fixed.CODE_TITLE,
    name_title: str = fixed.NAME_TITLE,
) -> RegionColumns:
    """Code and name column of the regions, looked up in a table's column dictionary.

    Column numbers move between boundary years, the topic group does not. A
    dictionary has some tens of rows, of which at most two come back.
    """
    groups = dictionary.filter((F.col("Type") == "TopicGroup") & (F.trim("Title") == topic_group))
    topics = dictionary.filter(F.col("Type") == "Topic").alias("t")
    found = (
        topics.join(groups.select("ID").alias("g"), F.col("t.ParentID") == F.col("g.ID"), "left_semi")
        .filter(F.trim("Title").isin(code_title, name_title))
        .groupBy(F.trim("Title").alias("title"))
        .agg(F.min_by("Key", F.col("Position").try_cast("int")).alias("key"))
    )
    keys = {row["title"]: row["key"] for row in found.collect()}
    if set(keys) != {code_title, name_title}:
        raise ValueError(f"the dictionary has no complete topic group {topic_group!r}")
    return RegionColumns(keys[code_title], keys[name_title])


def read_area_map(
    spark: SparkSession,
    paths: Mapping[int, str],
    columns: Mapping[int, RegionColumns] | RegionColumns,
) -> DataFrame:
    """One row per municipality and boundary year, with its region.

    ``paths`` maps a boundary year to the table of that year.
    """
    if not paths:
        raise ValueError("at least one boundary year is needed")

    def one_year(year: int, path: str) -> DataFrame:
        cols = columns if isinstance(columns, RegionColumns) else columns[year]
        raw = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_texts(spark, path)
        return normalize_columns(raw).select(
            F.lit(year).alias("boundary_year"),
            F.trim(AREA_CODE_HEADER).alias("municipality"),
            F.trim(AREA_NAME_HEADER).alias("municipality_name"),
            F.trim(cols.code).alias("region_code"),
            F.trim(cols.name).alias("region_name"),
        )

    return reduce(DataFrame.unionByName, (one_year(y, p) for y, p in sorted(paths.items())))


def add_labels(df: DataFrame, dimension: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Add the title of a coded column; codes without one keep a NULL label.

    Spark broadcasts the dimension when its size allows, and shuffles otherwise.
    """
    label = label or f"{key}_label"
    titles = dimension.select(F.trim("Key").alias("_key"), F.col("Title").alias(label))
    return df.join(titles, F.trim(df[key]) == titles["_key"], "left").drop("_key")
