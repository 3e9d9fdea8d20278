"""Physical-plan checks: the plans we want at scale, not only the right rows."""

import pytest

import __spark_entry__ as entry
from eventide.plans import catalog
from eventide.operators import marts
from eventide.sinks.warehouse import read_fact, write_fact

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_registered_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_invalid_rows_are_filtered_before_the_join(spark):
    plan = _plan(entry.queries()["top_content"](spark, SF))
    assert "BroadcastHashJoin [content_id" in plan and "LeftOuter" not in plan
    assert "size(" not in plan


def test_sliding_windows_do_not_multiply_events(spark):
    plan = _plan(entry.queries()["sliding_counts"](spark, SF))
    assert "Expand" not in plan


def test_whole_catalogue_is_read(spark):
    for name in ("enriched", "content_stats", "stats_card"):
        assert "LessThan(p_partkey" not in _plan(entry.queries()[name](spark, SF))


def test_dimension_is_broadcast(spark):
    plan = _plan(entry.queries()["enriched"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scan_is_pruned_and_filter_pushed(spark):
    plan = _plan(entry.queries()["window_stats"](spark, SF))
    # only the columns the query needs are read, the time filter reaches the scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_top_n_per_key_limits_before_shuffle(spark):
    plan = _plan(entry.queries()["recent_events"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_aggregations_are_partial_before_shuffle(spark):
    plan = _plan(entry.queries()["top_content"](spark, SF))
    assert "partial_sum" in plan or "merge_sum" in plan
    assert "TakeOrderedAndProject" in plan


def test_fact_reads_prune_date_partitions(spark, tmp_path):
    from eventide.operators.enrich import enrich
    from eventide.sources import fixtures as fx
    enriched, _ = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))
    path = str(tmp_path / "fact")
    write_fact(enriched, path, 0)
    fact = read_fact(spark, path)
    df = marts.engagement_stats(fact, "2024-01-05", "2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    df2 = marts.hourly_trends(fact, "2024-01-31 00:00:00", 7)
    plan2 = df2._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan2
    assert "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual(event_timestamp" in plan2
