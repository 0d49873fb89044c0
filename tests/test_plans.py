"""What the physical plans must and must not contain."""

import pytest

from tidemark.plans import registry

SF_DIR = "/root/testdata/sf0.001"
ROW_WISE = {
    "envelope_parse", "envelope_parse_multi", "envelope_encode", "symbol_allow_list",
    "envelope_heartbeats", "event_time", "trade_timestamp_v2", "stable_trade_id", "clock_label",
}


def plan_of(spark, name):
    result = registry.queries()[name](spark, SF_DIR)
    return result._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_no_cross_join_no_single_task(spark, name):
    plan = plan_of(spark, name)
    for unwanted in ("Python", "NestedLoop", "Cartesian", "RDDScan", "LocalTableScan"):
        assert unwanted not in plan
    single = plan.count("SinglePartition")
    assert single == (1 if name == "trade_count_share" else 0)  # one grand total, pre-summed


@pytest.mark.parametrize("name", sorted(ROW_WISE))
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(spark, name)


@pytest.mark.parametrize(
    "name", ["trade_count_by_symbol", "trade_count_trend", "volume_trend", "price_trend"]
)
def test_bounds_and_columns_reach_the_scan(spark, name):
    result = registry.queries()[name](spark, SF_DIR)
    scan = result._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in scan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
    read = next(line for line in scan.splitlines() if line.startswith("ReadSchema"))
    assert "user_id" not in read and "event_id" not in read


def test_windows_are_combined_before_the_shuffle(spark):
    plan = plan_of(spark, "tumbling_stats")
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan[plan.index("Exchange") :]


def test_latest_price_does_not_read_ids(spark):
    assert "sha2" not in plan_of(spark, "latest_price")


def test_newest_versions_are_found_by_hash(spark):
    plan = plan_of(spark, "upsert_latest_version")
    assert "SortAggregate" not in plan and "max_by" in plan
    assert plan.count("Exchange") == 2


def test_single_trends_compute_nothing_else(spark):
    plan = plan_of(spark, "trade_count_trend")
    assert "get_json_object" not in plan and "avg" not in plan


def test_messages_are_parsed_once(spark):
    assert plan_of(spark, "envelope_encode").count("from_json") == 1
