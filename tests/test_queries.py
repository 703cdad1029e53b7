"""Every registered query against its SQL, and what their plans must not contain."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from oracle_check import compare, connect

from eavcube.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# Ranks over a handful of rows (slices, clusters) may share one task; rows of the tables may not.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonMapInArrow"]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql_without_cross_join_python_or_global_window(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    for line in plan.splitlines():
        if "Window [" in line:
            assert ", [], " not in line and not line.rstrip().endswith("], []")
    assert compare(df, con, name) is None


def test_only_models_lack_sql():
    missing = set(QUERIES) - set(ORACLES)
    assert missing == {
        "cluster_profile", "forest_importance", "importance_groups", "kmeans_places",
    }


def test_entry_returns_the_annual_cube(spark):
    df = contract.entry(spark)
    assert df.columns == ["year", "fires", "severity", "area"] and df.count() > 0
