"""Physical-plan properties the scale design relies on."""

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")

BATCH = [n for n in entry.queries() if not n.endswith("_stream")]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_pages_topn", "hot_items_sql", "ad_click_capped"])
def test_rank_limits_run_before_the_shuffle(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filter_pushdown_and_pruning(spark):
    plan = _plan(entry.queries()["hot_items_topn"](spark, SF_SMALL))
    assert "EqualTo(event_type,view)" in plan
    scan = [l for l in plan.splitlines() if "ReadSchema" in l or "FileScan" in l][0]
    assert "props" in scan and "value" not in scan.split("ReadSchema")[-1]


def test_sliding_counts_collapse_panes_before_spreading(spark):
    plan = _plan(entry.queries()["hot_items_topn"](spark, SF_SMALL))
    # partial aggregation of panes, then Generate (the spread), then the window aggregation
    assert plan.index("Generate") < plan.rindex("HashAggregate")
    assert "Expand" not in plan
