"""Queries that write exports of whole tables and read them again."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from helpers import rows
from workload import queries
from workload.queries import REGISTRY


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """Orders and line items in six files each, and a place where exports are found again. Writing fails if it sorts a task's rows."""
    key = F.col("id")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (key % 300).cast("int")).cast("timestamp")
    orders = spark.range(0, 900, 1, 6).select(
        key.alias("o_orderkey"),
        (key % 37).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "5-LOW"))), (key % 3 + 1).cast("int")).alias("o_orderpriority"),
        day.alias("o_orderdate"),
        (key * 100.0).alias("o_totalprice"),
    )
    lines = spark.range(0, 900, 1, 6).select(
        key.alias("l_orderkey"),
        (key % 41).alias("l_suppkey"),
        (key % 7 + 1).cast("int").alias("l_linenumber"),
        (key % 10 / 100).alias("l_discount"),
        F.when(key % 2 == 0, "A").otherwise("N").alias("l_returnflag"),
        F.when(key % 5 == 0, "F").otherwise("O").alias("l_linestatus"),
        day.alias("l_shipdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries, "_scratch", lambda t, name: f"{tmp_path}/{name}")

    partition_by = DataFrameWriter.partitionBy

    def unsorted(writer, *columns):
        assert not columns, "a task sorts all its rows by the columns of the output's partitions"
        return partition_by(writer, *columns)

    def no_sort(*_, **__):
        raise AssertionError("a task sorts all its rows")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", unsorted)
    monkeypatch.setattr(f"{type(orders).__module__}.DataFrame.sortWithinPartitions", no_sort)
    return tmp_path


def test_situations_are_exported_by_every_task_and_not_sorted(spark, folder):
    found = REGISTRY["csv_situations"](spark, str(folder))
    expected = REGISTRY["cleaned_situations"](spark, str(folder))
    assert rows(found, *expected.columns) == rows(expected) and expected.count() > 50
    exports = [f.read_text() for f in Path(folder, "situations-csv").glob("part-*")]
    assert all(text.startswith("Name,Date entered,") and text.count("Date entered") == 1 for text in exports)
    assert sum(text.count("two\nlines") for text in exports) == 900
    # The largest export shrinks with the tasks that read the table.
    assert len(exports) > 5 and max(text.count("two\nlines") for text in exports) < 150


def test_an_empty_table_exports_no_situation(spark, folder):
    spark.read.parquet(f"{folder}/lineitem.parquet").limit(0).write.parquet(f"{folder}/empty/lineitem.parquet")
    assert REGISTRY["csv_situations"](spark, f"{folder}/empty").isEmpty()


def test_each_case_export_is_one_file_and_not_sorted(spark, folder):
    found = REGISTRY["incremental_counts"](spark, str(folder))
    expected = REGISTRY["cleaned_cases"](spark, str(folder))
    assert rows(found, *expected.columns) == rows(expected) and expected.count() > 20
    assert rows(found.select("counted", "dropped").distinct()) == [("4,0,1,1", "0,0,0,1")]
    assert sorted(f.parent.name for f in Path(folder, "increments", "exports").glob("export=*/part-*")) == [f"export={i}" for i in range(5)]
