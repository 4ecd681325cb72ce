"""Tables and folders that are replaced as a whole or not at all.

Every write goes to a folder of its own below ``versions``. Once it is complete a
row with its name is added to the log ``_commits``, which is what readers follow: a
write that fails half-way adds no row, and a reader that has begun keeps its files.
Older versions stay until someone expires them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version long, folder string, facts string, written timestamp"


class Version(NamedTuple):
    number: int
    folder: str
    #: What the writer noted, as plain values.
    facts: dict


def new_version(path: str) -> str:
    """A folder to write the next version of ``path`` to."""
    return f"{path.rstrip('/')}/versions/{uuid4().hex}"


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The last version committed; None where nothing was committed yet."""
    try:
        log = spark.read.schema(_LOG).json(f"{path.rstrip('/')}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = log.orderBy(F.desc("version"), F.desc("written"), "folder").first()
    return None if last is None else Version(last.version, f"{path.rstrip('/')}/versions/{last.folder}", json.loads(last.facts))


def commit(spark: SparkSession, path: str, folder: str, facts: Mapping | None = None) -> Version:
    """Makes a completely written ``folder`` the current version of ``path``, by one small file."""
    before = current_version(spark, path)
    number = before.number + 1 if before else 1
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("version"),
        F.lit(folder.rsplit("/", 1)[1]).alias("folder"),
        F.lit(json.dumps(dict(facts or {}))).alias("facts"),
        F.current_timestamp().alias("written"),
    )
    row.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/_commits")
    return Version(number, folder, dict(facts or {}))


def commit_table(df: DataFrame, path: str, facts: Mapping | None = None, partition_by: Sequence[str] = ()) -> Version:
    """Writes ``df`` as the next version of the table at ``path``."""
    folder = new_version(path)
    df.write.partitionBy(*partition_by).parquet(folder)
    return commit(df.sparkSession, path, folder, facts)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a committed table; a plain Parquet table as it is."""
    version = current_version(spark, path)
    return spark.read.parquet(path if version is None else version.folder)
