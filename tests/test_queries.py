"""Every registered query against its SQL counterpart, and the shape of its plan."""

import os

import compare
import pytest

from orderpulse.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    compare.assert_same(QUERIES[name](spark, SF_DIR), ORACLES[name], SF_DIR)


def test_file_times_have_no_sql(spark):
    assert set(QUERIES) - set(ORACLES) == {"last_write_per_layer"}
    assert QUERIES["last_write_per_layer"](spark, SF_DIR).filter("last_write_at IS NULL").isEmpty()


BATCH = [name for name in QUERIES if not name.startswith("stream_") and name != "partitioned_event_counts"]


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "EvalPython"):
        assert slow not in plan


def test_filters_reach_the_scan(spark):
    plan = QUERIES["top_vendors"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "l_extendedprice" not in plan


def test_hour_counts_read_no_measures(spark):
    plan = QUERIES["hourly_volume"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "value:double" not in plan and "SortAggregate" not in plan
