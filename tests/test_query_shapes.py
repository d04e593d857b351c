"""Plans stay the ones we want: pruned scans, early limits, no Python rows, no forced broadcasts."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import fieldmill
import pytest
from pyspark.sql import functions as F

from fieldmill.operators import group_stats, lookup_roles, mode_per_group, top_per_group
from fieldmill.plans.queries.grouping import shipments
from fieldmill.plans.registry import QUERIES
from fieldmill.sources import load_table

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def scanned_columns(plan: str) -> set[str]:
    return {
        column
        for schema in re.findall(r"ReadSchema: struct<(.*)>", plan)
        for column in re.findall(r"(\w+):", schema)
    }


def test_shipments_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["timing_label"](spark, FOLDER))
    assert scanned_columns(plan) == {"l_orderkey", "l_suppkey", "l_shipdate", "o_orderkey", "o_orderdate"}
    assert "IsNotNull(l_orderkey)" in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_sql_string"](spark, FOLDER))
    assert "EqualTo(l_linestatus,F)" in plan and "GreaterThan(l_quantity,20.0)" in plan
    # A filter on the grouped result moves below the grouping.
    events = load_table(spark, FOLDER, "events")
    plan = plan_of(mode_per_group(events, ["user_id"], "event_type").where("user_id = 3"))
    assert "EqualTo(user_id,3)" in plan


def test_partition_filter_prunes_folders(spark):
    plan = plan_of(QUERIES["partitioned_write_read"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[.*o_orderstatus", plan)


def test_one_winner_per_group_is_cut_before_the_shuffle(spark):
    events = load_table(spark, FOLDER, "events")
    plan = plan_of(top_per_group(events, ["user_id"], "value", ties="one", tiebreak=["event_id"]))
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan and "Final" in plan


def test_top_k_is_one_operator(spark):
    for name in ("ordered_limit", "most_delayed_top5", "avg_children_by_group"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER)), name


def test_small_dimensions_broadcast_by_size_only(spark, no_broadcast):
    lines = load_table(spark, FOLDER, "lineitem")
    nations = load_table(spark, FOLDER, "nation")
    roles = {"l_linenumber": "a", "l_suppkey": "b"}
    plan = plan_of(lookup_roles(lines, nations, "n_nationkey", "n_name", roles))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin LeftOuter") >= 2


def test_small_dimensions_do_broadcast(spark):
    lines = load_table(spark, FOLDER, "lineitem")
    nations = load_table(spark, FOLDER, "nation")
    roles = {"l_linenumber": "a", "l_suppkey": "b"}
    plan = plan_of(lookup_roles(lines, nations, "n_nationkey", "n_name", roles))
    assert plan.count("BroadcastHashJoin LeftOuter") >= 2


PYTHON_QUERIES = {"timing_label_udf"}


def test_no_module_leaves_the_jvm_for_rows():
    for source in Path(fieldmill.__file__).parent.rglob("*.py"):
        if "llm" not in source.parts:
            text = source.read_text()
            assert "mapInPandas" not in text and ".rdd" not in text, source


def test_sketches_are_made_above_the_distinct_values(spark):
    for name in ("approx_distinct_keys", "distinct_counts"):
        for keys, functions in re.findall(r"Keys \[\d+\]: \[(.*)\]\nFunctions \[\d+\]: \[(.*)\]", plan_of(QUERIES[name](spark, FOLDER))):
            assert not ("approx_count_distinct" in functions and ("l_partkey" in keys or "segment" in keys or "value" in keys))


def test_xml_is_parsed_once_per_row(spark):
    plan = plan_of(QUERIES["most_common_age"](spark, FOLDER))
    assert len(re.findall(r"from_xml\(", plan)) == 1


def test_no_query_runs_python_per_row_or_a_cross_join(spark):
    for name, query in QUERIES.items():
        plan = plan_of(query(spark, FOLDER))
        assert "BatchEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert ("ArrowEvalPython" in plan) == (name in PYTHON_QUERIES), name


def test_means_are_grouped_partially_before_the_shuffle(spark, no_broadcast):
    plan = plan_of(shipments(spark, FOLDER).groupBy("l_suppkey").agg(F.avg("delay")))
    assert plan.count("partial_avg") >= 1 and plan.count("SortMergeJoin Inner") >= 1


def test_gold_shuffles_each_silver_table_once(spark, no_broadcast):
    plan = plan_of(QUERIES["gold_bids"](spark, FOLDER))
    assert plan.count("SortMergeJoin LeftOuter") >= 1 and plan.count("SortMergeJoin Inner") >= 1
    # Device and site twice, once for either part, the impressions for each part.
    assert len(re.findall(r"\) Exchange\n", plan)) <= 6


def test_line_items_are_shuffled_once_for_the_nation_lookup(spark, no_broadcast):
    plan = plan_of(QUERIES["dual_role_lookup"](spark, FOLDER))
    assert plan.count("hashpartitioning(l_orderkey") == 1
    # Suppliers meet counts, not line items.
    assert re.search(r"HashAggregate\(keys=\[c_nationkey|Keys \[2\]: \[c_nationkey#\d+, l_suppkey", plan)


def test_few_groups_are_broadcast_and_the_rows_stay(spark):
    lines = load_table(spark, FOLDER, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey")
    wide = lines.unionByName(lines)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    for frame in (
        group_stats(wide, ["l_returnflag"], "l_quantity", "q"),
        top_per_group(wide, ["l_returnflag"], "l_quantity"),
    ):
        plan = plan_of(frame)
        assert "BroadcastHashJoin Inner BuildRight" in plan
        assert not re.search(r"\) Exchange\n", plan)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
