"""The corpus queries that SQL can express, against it, and the plans of the native ones."""

import pytest

from epitally.llm.oracle import ORACLE
from epitally.llm.queries import REGISTRY
from workload.compare import connect, differences


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data_dir, name):
    assert differences(REGISTRY[name](spark, data_dir), connect(data_dir), ORACLE[name]) == []


@pytest.mark.parametrize("name", ["op5_mix_sources", "op9_license_scan"])
def test_native_queries_run_no_python(spark, data_dir, name):
    plan = REGISTRY[name](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
