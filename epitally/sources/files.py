"""Delimited and columnar files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from epitally.sources.numbers import NUMERIC, column_marks, number, reject_reason
from epitally.sources.records import FileShape, header_names, list_files, parsed, read_records, separator_of, shapes_of
from epitally.sources.schemas import InputColumn

_PLACE = "_place_in_file"

#: Byte ranges up to which a file with line breaks inside quotes is read faster by one native task than by many that join lines.
SPLIT_BEYOND = 8


def normalize_columns(df: DataFrame) -> DataFrame:
    """Runs of blanks in column names become one dot."""
    return df.toDF(*(re.sub(r"\s+", ".", name) for name in df.columns))


def first_column_like(df: DataFrame, prefix: str) -> DataFrame:
    """Give the first column whose name starts with ``prefix`` exactly that name.

    A header that occurs twice is read back with numbers behind it; the first
    occurrence is the one wanted, the other ones are dropped.
    """
    matches = [name for name in df.columns if name.startswith(prefix)]
    if not matches:
        raise ValueError(f"no column starts with {prefix!r}")
    return df.drop(*matches[1:]).withColumnRenamed(matches[0], prefix)


class NoHeader(ValueError):
    """None of the files to read has a header."""


class _Part(NamedTuple):
    """Files with the same columns, as texts. ``_place`` says where a row stands, if that was asked for."""

    texts: DataFrame
    sep: str


def _native(spark: SparkSession, files: Sequence[str], names: Sequence[str], sep: str, placed: bool, **options) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in names])
    texts = spark.read.schema(schema).options(header=True, sep=sep, quote='"', escape='"', **options).csv(list(files))
    if not placed:
        return texts
    # Rows of one block of a file come in order in one task.
    block = F.col("_metadata.file_block_start")
    return texts.withColumn(_PLACE, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("number")))


def _parts(spark: SparkSession, paths: Sequence[str], sep: str, multi_line: bool, placed: bool, split_beyond: int = SPLIT_BEYOND) -> list[_Part]:
    """The files under ``paths``, those with the same header read together. One pass over all files finds out how."""
    listed = list_files(spark, paths)
    shapes = shapes_of(spark, listed)
    if not shapes:
        raise NoHeader(f"no file under {', '.join(paths)} has a header")
    groups: dict[tuple, list[FileShape]] = {}
    for shape in shapes.values():
        own = separator_of(shape.header) if sep == "auto" else sep
        whole = shape.irregular or len(shape.starts) <= split_beyond
        way = "lines" if not multi_line or not shape.broken else "whole" if whole else "records"
        groups.setdefault((tuple(header_names(shape.header, own)), own, way), []).append(shape)
    parts = []
    for (names, own, way), members in groups.items():
        files = [s.path for s in members]
        if way == "records":
            texts = parsed(read_records(spark, members, listed), names, own)
            texts = texts.withColumnRenamed("_place", _PLACE) if placed else texts.drop("_place")
        elif way == "whole":
            texts = _native(spark, files, names, own, placed, multiLine=True)
        elif multi_line:
            texts = _native(spark, files, names, own, placed)
        else:
            # A record torn apart by a line break has too few columns. All columns are
            # parsed so that it is noticed, and it stops the reading.
            texts = _native(spark, files, names, own, placed, mode="FAILFAST", columnPruning=False)
        parts.append(_Part(normalize_columns(texts), own))
    return parts


def read_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All columns of delimited files as text; files that lack a column have NULL there."""
    paths = [path] if isinstance(path, str) else list(path)
    parts = _parts(spark, paths, "auto", True, False)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (p.texts for p in parts))


def detect_separator(spark: SparkSession, path: str | Sequence[str]) -> str:
    """Comma, or semicolon when splitting at commas leaves a single column, by the first file with a header."""
    paths = [path] if isinstance(path, str) else list(path)
    shapes = shapes_of(spark, list_files(spark, paths))
    return separator_of(shapes[min(shapes)].header)


def read_events(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: Sequence[InputColumn],
    sep: str = "auto",
    multi_line: bool = True,
    duplicated: Sequence[str] = (),
    order: str | None = None,
    rejects: str | None = None,
    split_beyond: int = SPLIT_BEYOND,
) -> DataFrame:
    """Read the columns of ``schema`` from CSV or Parquet, by name.

    CSV is read as text, and only the columns asked for are parsed. Files may order
    their columns differently, and each may use its own separator; empty files are
    left out. Line breaks inside quotes are text; such files of more byte ranges than
    ``split_beyond`` are split among tasks all the same. With ``multi_line=False`` they are refused: a record with another
    number of columns stops the reading. Numbers are read with the marks that their
    column uses; texts that are none are NULL, and listed with file, place and reason
    in the table ``rejects``, if one is named. ``duplicated`` names headers that occur
    more than once, of which the first is used. ``order`` names a further column
    that orders the rows as the files list them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if paths[0].rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(*paths)
        if order is not None:
            place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
            raw = raw.withColumn(order, place)
        raw = _first_columns(normalize_columns(raw), duplicated)
        return raw.select(*(_cast(c).alias(c.name) for c in schema), *([order] if order else []))
    parts = _parts(spark, paths, sep, multi_line, order is not None or rejects is not None, split_beyond)
    parts = [_Part(_first_columns(p.texts, duplicated), p.sep) for p in parts]
    marks = column_marks(parts, schema)
    if rejects is not None:
        write_table(reduce(DataFrame.unionByName, (_rejected(p.texts, schema, m) for p, m in zip(parts, marks, strict=True))), rejects)
    more = [F.col(_PLACE).alias(order)] if order else []
    return reduce(DataFrame.unionByName, (p.texts.select(*(_typed(c, m).alias(c.name) for c in schema), *more) for p, m in zip(parts, marks, strict=True)))


def _first_columns(df: DataFrame, duplicated: Sequence[str]) -> DataFrame:
    return reduce(first_column_like, duplicated, df)


def _cast(column: InputColumn) -> Column:
    col = F.col(f"`{column.header}`")
    return col if column.data_type == "string" else F.trim(col).try_cast(column.data_type)


def _typed(column: InputColumn, marks: Mapping[str, str]) -> Column:
    if column.data_type in NUMERIC:
        return number(F.col(f"`{column.header}`"), column.data_type, marks[column.name])
    return _cast(column)


def _rejected(texts: DataFrame, schema: Sequence[InputColumn], marks: Mapping[str, str]) -> DataFrame:
    """(file, block, number, column, value, reason) of every text that should be a number and is none."""
    found = []
    for c in schema:
        if c.data_type in NUMERIC:
            col = F.col(f"`{c.header}`")
            found.append(F.struct(F.lit(c.name).alias("column"), col.alias("value"), reject_reason(col, c.data_type, marks[c.name]).alias("reason")))
    none = F.struct(F.lit("").alias("column"), F.lit("").alias("value"), F.lit(None).cast("string").alias("reason"))
    each = F.filter(F.array(none, *found), lambda x: x["reason"].isNotNull())
    return texts.select(f"{_PLACE}.*", F.inline(each))


def source_modified(spark: SparkSession, path: str) -> datetime:
    """Latest modification time of the files under ``path``; their content is not read."""
    files = spark.read.format("binaryFile").load(path).select("modificationTime")
    return files.agg(F.max("modificationTime")).first()[0]


def modification_times(spark: SparkSession, paths: Sequence[str]) -> dict[str, datetime]:
    """For each of several paths what ``source_modified`` gives, from one job that lists their files."""
    files = spark.read.format("binaryFile").load(list(dict.fromkeys(paths))).select("path", "modificationTime").collect()
    found = {}
    for path in paths:
        own = re.sub("^file:/+", "/", path).rstrip("/")
        names = [(re.sub("^file:/+", "/", unquote(f.path)), f.modificationTime) for f in files]
        times = [time for name, time in names if name == own or name.startswith(f"{own}/")]
        found[path] = max(times) if times else source_modified(spark, path)
    return found


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
