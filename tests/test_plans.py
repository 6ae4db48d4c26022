"""Plan shapes that matter at scale stay as designed (final adaptive plans)."""

import pytest

from conftest import SF_SMALL
from editstream.plans.catalog import BATCH_QUERIES
from editstream.plans.explain import condensed


@pytest.fixture(scope="module")
def plans(spark):
    names = ["window_metrics", "live_snapshot", "enrich_edits", "enriched_snapshot", "wiki_trend_all",
             "top_wikis", "metric_merge_outer", "trend_picker", "kpi_summary", "wiki_trend"]
    return {n: "\n".join(condensed(BATCH_QUERIES[n](spark, SF_SMALL))) for n in names}


def test_aggregations_are_partial_before_the_shuffle(plans):
    assert "partial_count(1)" in plans["window_metrics"]
    assert "partial_max_by" in plans["live_snapshot"]


def test_dimension_join_is_broadcast_and_after_the_reduce(plans):
    assert "BroadcastHashJoin" in plans["enrich_edits"] and "LeftOuter, BuildRight" in plans["enrich_edits"]
    snap = plans["enriched_snapshot"].split("\n")
    join = next(i for i, line in enumerate(snap) if "BroadcastHashJoin" in line)
    agg = next(i for i, line in enumerate(snap) if "max_by" in line)
    assert join < agg                    # the join sits above (after) the aggregation


def test_top_k_and_per_key_limits_are_partial(plans):
    assert "WindowGroupLimit" in plans["wiki_trend_all"] and "Partial" in plans["wiki_trend_all"]
    assert "TakeOrderedAndProject(limit=15" in plans["top_wikis"]
    assert "TakeOrderedAndProject(limit=12" in plans["wiki_trend"]


def test_merge_join_reuses_aggregate_partitioning(plans):
    merge = plans["metric_merge_outer"]
    assert "SortMergeJoin" in merge
    assert merge.count("Exchange hashpartitioning") == 2    # the two aggregations' own shuffles only


def test_picker_computes_labels_once(plans):
    assert "ReusedExchange" in plans["trend_picker"]


def test_kpis_are_one_aggregation_without_joins(plans):
    kpi = plans["kpi_summary"]
    assert "Union" in kpi and "Join" not in kpi and "Subquery" not in kpi


def test_scans_read_only_needed_columns(plans):
    scan = next(line for line in plans["wiki_trend"].split("\n") if "FileScan" in line)
    assert "ReadSchema: struct<ts:timestamp_ntz,props:string>" in scan
