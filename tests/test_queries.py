"""Every registered query against its SQL, and the shape of the plans."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from epitally.operators.counts import monthly_counts
from epitally.operators.series import SeriesSpec, series
from epitally.plans.monthly import monthly_incidence, windowed_counts
from epitally.config import Report
from epitally.operators.period_table import SITUATION_STYLE, period_table
from epitally import staging
from epitally.staging import stage, staging_dir
from helpers import day
from workload.compare import connect, differences
from workload.oracle import ORACLE
from workload.queries import REGISTRY


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def database(data_dir):
    return connect(data_dir)


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, data_dir, database, name, monkeypatch):
    staged = []
    write = staging.stage

    def watched(frame, label):
        staged.append(plan_of(frame))
        return write(frame, label)

    for module in ("workload.queries", "workload.projections", "epitally.staging"):
        monkeypatch.setattr(f"{module}.stage", watched)
    df = REGISTRY[name](spark, data_dir)
    assert differences(df, database, ORACLE[name]) == []
    for plan in [*staged, plan_of(df)]:  # also what was written on the way
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
        assert "hashpartitioning(category" not in plan or "REPARTITION_BY_NUM" not in plan


@pytest.mark.parametrize("name", ["report_window", "quality_flags"])
def test_each_event_table_is_read_once(spark, data_dir, name, monkeypatch):
    staged = []
    write = staging.stage

    def watched(frame, label):
        staged.append(plan_of(frame))
        return write(frame, label)

    for module in ("workload.queries", "workload.projections", "epitally.staging"):
        monkeypatch.setattr(f"{module}.stage", watched)
    plans = "".join([plan_of(REGISTRY[name](spark, data_dir)), *staged])
    scans = Counter(re.findall(r"(\w+)\.parquet\]", plans))
    assert scans["lineitem"] <= 1 and scans["part"] == 0
    assert scans["orders"] == (2 if name == "quality_flags" else 1)  # cases, and the orders of the line items


@pytest.mark.parametrize("name", ["scenario_table", "setting_table", "top5_topics_wide"])
def test_the_year_takes_no_second_scan_of_the_orders(spark, data_dir, name, monkeypatch):
    staged = []
    write = staging.stage

    def watched(frame, label):
        staged.append(plan_of(frame))
        return write(frame, label)

    for module in ("workload.queries", "workload.projections", "epitally.staging"):
        monkeypatch.setattr(f"{module}.stage", watched)
    plans = "".join([plan_of(REGISTRY[name](spark, data_dir)), *staged])
    scans = Counter(re.findall(r"(\w+)\.parquet\]", plans))
    assert scans["orders"] == scans["lineitem"] == 1


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


# Plans


def hot_events(spark, rows=30000):
    """Every third event has the same region, month and category."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(rows).select(
        F.when(hot, "A").otherwise(F.concat(F.lit("R"), i % 7)).alias("region"),
        F.when(hot, F.lit(day("2021-05-09"))).otherwise(F.date_add(F.lit(day("2020-01-01")), (i % 700).cast("int"))).alias("event_date"),
        F.when(hot, "x").otherwise(F.concat(F.lit("c"), i % 11)).alias("category"),
    )


def people(spark):
    names = ["A", "ALL_REGIONS", *(f"R{i}" for i in range(7))]
    data = [(n, y, 1000000) for n in names for y in (2020, 2021)]
    return stage(spark.createDataFrame(data, "region string, year int, population long"), "people")


def test_hot_keys_are_reduced_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    hot_events(spark).write.parquet(path)
    counts = monthly_counts(spark.read.parquet(path), ["category"])
    plan = plan_of(counts)
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 1
    assert counts.filter("region = 'A'").first().n == 10000


def test_events_are_scanned_once_for_a_whole_table(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    hot_events(spark).write.parquet(path)
    counts = windowed_counts(spark.read.parquet(path), ["category"], Report(2), "hot")
    monthly = monthly_incidence(counts, ["category"], people(spark), ["A", *(f"R{i}" for i in range(7))])
    tables = [
        period_table(monthly, "category", Report(2), 2021, ["A"], SITUATION_STYLE),
        series(monthly, "category", SeriesSpec("x", "s", include=("x",))),
    ]
    for df in tables:
        plan = plan_of(df)
        assert "events.parquet" not in plan
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = tables[0].filter("category = 'x'").first()
    assert (found.A_n, found.A_incidence) == (10000, 10000.0)


def test_the_dense_table_takes_one_shuffle_of_its_cells(spark):
    counts = stage(monthly_counts(hot_events(spark), ["category"]), "cells")
    plan = plan_of(monthly_incidence(counts, ["category"], people(spark), ["A", *(f"R{i}" for i in range(7))]))
    # Before the months unfold, only the regions of each category are spread.
    cells = re.findall(r"Exchange hashpartitioning\((region[^)]*month_start[^)]*)\)", plan)
    assert len(cells) == 1, Counter(cells)


def test_staged_tables_live_in_the_configured_folder(spark):
    folder = staging_dir(spark)
    df = stage(spark.range(3), "probe")
    assert df.inputFiles()[0].replace("file://", "").replace("file:", "").startswith(folder.replace("file:", ""))
    assert df.count() == 3
