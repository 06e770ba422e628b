"""Plan discipline: the physical plans the design relies on (one Window per
entity spec, bounded broadcasts, pruned and pushed-down scans)."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_rolling_and_lag_columns_share_one_window(spark):
    for key in ("rolling_mean", "lag_features", "select_pattern"):
        plan = _plan(spark, key)
        assert plan.count("Window [") == 1, key
        # exactly one shuffle by the entity alone (the window's), besides the panel aggregate's
        assert len(re.findall(r"Exchange hashpartitioning\(entity#\d+L?, \d+\)", plan)) == 1, key


def test_event_panel_is_one_aggregate_shuffle(spark):
    plan = _plan(spark, "group_count")
    # the panel pivot is a conditional aggregate: one shuffle for it, one for the profile
    assert plan.count("Exchange hashpartitioning") == 2
    assert "pivotfirst" not in plan


def test_bounded_dimensions_are_broadcast(spark):
    for key in ("join_left", "join_inner", "lag_features"):
        assert "BroadcastHashJoin" in _plan(spark, key), key


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _plan(spark, "filter_in_since")
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "PushedFilters: [" in scan and "In(l_returnflag" in scan
    read = scan.split("ReadSchema: ")[1]
    assert "l_extendedprice" not in read and "l_shipdate" in read


def test_no_single_partition_exchange_outside_one_row_aggregates(spark):
    for key in ("rolling_mean", "fill_parent_mean", "share_of_total", "join_left_composite", "pivot_strict"):
        assert "SinglePartition" not in _plan(spark, key), key


def test_broadcast_only_after_size_check(spark):
    from panelforge.operators import joins as J
    small = spark.range(5).selectExpr("id AS k", "id AS v")
    fact = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, x int")
    hinted = fact.join(J.broadcast_if_small(small, max_bytes=1 << 10), "k")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = fact.join(J.broadcast_if_small(small, max_bytes=8), "k")    # over the bound: no hint
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
