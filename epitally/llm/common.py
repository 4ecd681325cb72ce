"""Helpers that the corpus operators share."""

from __future__ import annotations

import string
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.staging import stage, staging_dir

#: Words of a text: runs of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, folder: str, name: str) -> DataFrame:
    """One of the input tables, by whatever path Spark can read."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that ``df`` does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def with_position(df: DataFrame, order: list[Column], column: str, name: str) -> DataFrame:
    """Adds the gapless index of each row in the given order, counted from 0.

    A window over all rows would run in one task. Here the rows are sorted by
    range over all tasks and written once; each task numbers its own rows, and
    the driver adds up one row count per task. Equal rows get different numbers.
    """
    (mark,) = fresh(df, "_mark")
    ordered = stage(df.orderBy(*order).withColumn(mark, F.monotonically_increasing_id()), name)
    task = F.shiftrightunsigned(mark, 33).cast("int")
    counts = {r.task: r.n for r in ordered.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for t in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(t, 0)
    start = F.element_at(F.array(*(F.lit(s).cast("long") for s in starts)), task + 1)
    return ordered.withColumn(column, start + F.col(mark).bitwiseAND((1 << 33) - 1)).drop(mark)


class BucketedTables:
    """Tables written to the staging folder and dealt by one key into the same files, so that joins on it move no rows.

    They are known to the session's catalog while the ``with`` block lasts; what
    it returns must not read them afterwards.
    """

    def __init__(self, spark, key: str, buckets: int):
        self._spark, self._key, self._names = spark, key, []
        self.buckets = max(1, min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        for name in self._names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write(self, df: DataFrame, label: str, deal: bool = False) -> DataFrame:
        """``deal`` moves rows to the tasks of their buckets first; rows read from such tables are there already."""
        tag = uuid4().hex
        if deal:
            df = df.repartition(self.buckets, self._key)
        name = f"spark_catalog.default.epitally_{label}_{tag}"
        self._names.append(name)
        path = f"{staging_dir(self._spark)}/epitally/{label}-{tag}"
        df.write.format("parquet").bucketBy(self.buckets, self._key).option("path", path).saveAsTable(name)
        return self._spark.table(name)
