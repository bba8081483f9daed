"""What the physical plans of the registered queries may and may not contain."""

import os

import pytest

import __spark_entry__ as contract
from conftest import plan_of

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")

# These run streams, write tables or fit models when they are called; their own tests cover them.
ACTING = {
    "stream_window_agg_5m", "stream_trades_hourly", "stream_scored_messages", "csv_landing", "json_documents",
    "schema_evolution", "partitioned_table", "discovered_tables", "exported_tables", "migrated_table", "migration_audit",
    "kmeans_clusters", "pca_components", "stream_topic_offsets", "topic_positions", "stream_window_upserts",
    "dedup_bucketed_history", "merged_profile", "extract_landed", "extract_marks",
    "published_tables", "export_sweep",
}
LAZY = sorted(set(contract.queries()) - ACTING)


def build(spark, name):
    return contract.queries()[name](spark, SMALL)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(build(spark, name))
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{node} in\n{plan}"


@pytest.mark.parametrize("name, exchanges", [
    ("kpi_monthly_tx", 1), ("kpi_status_counts", 1), ("dedup_first", 1), ("window_agg_5m", 1), ("unique_key", 1),
    ("wide_to_long", 0), ("scored_json", 0), ("row_flags", 0), ("lookback_6m", 0), ("url_parts", 0), ("flatten_deep", 0),
    ("one_hot", 0), ("column_profile", 2), ("dominant_type", 2), ("user_features", 2),
])
def test_shuffles(spark, name, exchanges):
    plan = plan_of(build(spark, name))
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") == exchanges, plan


@pytest.mark.parametrize("name, columns", [
    ("kpi_status_counts", "ReadSchema: struct<o_orderstatus:string>"),
    ("unique_key", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"),
    ("window_agg_5m", "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert columns in plan_of(build(spark, name))


def test_date_bounds_reach_the_scan(spark):
    plan = plan_of(build(spark, "lookback_6m"))
    pushed = plan[plan.index("PushedFilters") :]  # long values are shortened in the plan text
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_top_one_is_limited_before_the_shuffle(spark):
    plan = plan_of(build(spark, "dedup_last"))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_partition_filter_prunes(spark):
    plan = plan_of(build(spark, "partitioned_table"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan
