"""Plan shape: the properties the operators are designed around, checked on
the executed physical plans at sf0.001."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()          # finalise the adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_scan_and_topn_is_partial(spark):
    plan = _plan(spark, "hot_items_top3")
    assert "EqualTo(event_type,view)" in plan                 # predicate pushed into parquet
    assert "WindowGroupLimit" in plan and "Partial" in plan   # top-N limited before the shuffle
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


@pytest.mark.parametrize("name", ["interval_join", "reconcile_unmatched_orders", "gate", "order_ship_interval_join",
                                  "window_join"])
def test_range_joins_are_equi_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["group_count_changelog", "rising_run_alert", "allowed_lateness"])
def test_keyed_scans_hash_aggregate(spark, name):
    plan = _plan(spark, name)
    assert "SortAggregate" not in plan


def test_no_python_udf_in_hash(spark):
    plan = _plan(spark, "hash_udf")
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
