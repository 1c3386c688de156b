"""Plan checks for every registered query: no cartesian product, no
nested-loop join, no Python evaluation (but for one named query), and scans read pruned schemas."""

from __future__ import annotations

import os
import re

import pytest

from propspark.plans import registry

registry.load_all()

SF = os.environ.get("PROPSPARK_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
#: A sequential scan of bounded groups, which no built-in expresses.
ALLOWED = {"poi_dedup_greedy": {"FlatMapGroupsInPandas"}}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plan_has_no_cartesian_or_python(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    for bad in set(FORBIDDEN) - ALLOWED.get(name, set()):
        assert bad not in plan, f"{name}: {bad} in plan"


@pytest.mark.parametrize("name", ["top5_departments", "view_department_stats", "sales_geo_features",
                                  "clean_sales_pipeline", "dedup_subset"])
def test_scans_are_pruned(spark, name):
    df = registry.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        assert m.group(1).count(":") <= 8, f"{name}: wide scan {m.group(1)}"
