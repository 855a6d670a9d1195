"""Plan-shape regressions: column pruning reaches the scan, no cartesian or
nested-loop joins, one window exchange for the feature build."""

import re

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL


def _plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_panel_scan_is_pruned(spark):
    plan = _plan(spark, "panel")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    orders = [s for s in schemas if "o_" in s]
    assert orders and all(s == "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" for s in orders)


@pytest.mark.parametrize("name", ["feature_panel", "unit_profile", "request_counts", "active_requests",
                                  "silence_gaps", "alert_hold", "roc_curve", "class_report", "silhouette",
                                  "best_runs", "cust_backtest_metrics", "order_zscore"])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_feature_build_partitions_by_unit(spark):
    plan = _plan(spark, "feature_panel")
    assert "hashpartitioning(unit" in plan
    assert "Exchange SinglePartition" not in plan


@pytest.mark.parametrize("name", ["promote", "registry_report", "gate", "best_runs", "inhibit_anti", "alert_transitions", "describe",
                                  "drift_score"])
def test_inputs_are_scanned_a_few_times(spark, name):
    assert _plan(spark, name).count("FileScan") <= 6
