"""The plans Spark chooses."""

import pytest

from ratewatch.plans.queries import QUERIES as EVERY

QUERIES = {n: q for n, q in EVERY.items() if not n.startswith("stream_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_cross_join_or_unchecked_loop(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name", ["recent_ticks", "recent_means", "anomaly_report"])
def test_limits_are_top_n(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf))


def test_groups_are_cut_by_the_same_plan_for_any_number(spark, sf):
    # Spark adds its own early cut, WindowGroupLimit, where the number is small.
    few, many = (plan(QUERIES[name](spark, sf)) for name in ("recent_ticks_per_marker", "recent_ticks_many"))
    for text in (few, many):
        assert text.count("Window [") == 2 and text.count("Exchange hashpartitioning(") == 2


@pytest.mark.parametrize("name", ["recent_means", "means_since_recent", "anomaly_report", "anomalies_since_recent"])
def test_served_results_are_read_by_marker_and_date(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    pruned = [p.split("PushedFilters")[0] for p in text.split("PartitionFilters: ")[1:]]
    assert any("fx_marker" in p and "timestamp_d" in p for p in pruned)


@pytest.mark.parametrize("name", ["ticks_latest", "tumbling_count", "sliding_mean", "baseline_per_marker"])
def test_aggregates_combine_by_hash_before_the_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "HashAggregate" in text and "partial_" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["frame_roundtrip", "ticks_from_json"])
def test_records_are_parsed_once(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert text.count("from_json(") == 1


def test_rescued_records_are_parsed_once(spark, sf):
    assert plan(QUERIES["ticks_rescued"](spark, sf).where("rescued is not null and open > 1")).count("parseJson(") == 1


def test_small_anomaly_tables_are_broadcast_without_shuffling_ticks(spark, sf):
    text = plan(QUERIES["ticks_in_anomaly"](spark, sf))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_scans_read_needed_columns_and_push_filters(spark, sf):
    text = plan(QUERIES["baseline_one_marker"](spark, sf))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "EqualTo(event_type,click)" in text and "GreaterThanOrEqual(ts" in text
