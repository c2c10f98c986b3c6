"""Plan shapes the design relies on (checked on the physical plans)."""

import os
import re

import pytest

from relaylens.operators.alerts import low_rate_alerts
from relaylens.operators.detail import normalize_detail
from relaylens.operators.summary import daily_summary, daily_summary_two_branch
from relaylens.sources.messages import messages

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobinPartitioning)", plan))


def _scan_columns(df) -> list[list[str]]:
    """Columns each Parquet scan of the physical plan reads (pruned schema)."""
    root = df._jdf.queryExecution().executedPlan()
    if root.nodeName() == "AdaptiveSparkPlan":
        root = root.inputPlan()
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan "):
            out.append(sorted(node.requiredSchema().fieldNames()))
        it = node.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return sorted(out, key=len)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The adapter rows written once as Parquet, as a load stages them."""
    path = str(tmp_path_factory.mktemp("staged") / "raw")
    messages(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_adapter_joins_narrow_rows_by_sort_merge(spark):
    df = messages(spark, SF)
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    orders, lineitem = _scan_columns(df)
    assert orders == ["o_orderdate", "o_orderkey", "o_orderpriority"]
    assert lineitem == sorted(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus"])


def test_summary_is_one_aggregation_without_join(staged):
    df = daily_summary(staged, "w")
    plan = _plan(df)
    assert "Join" not in plan
    assert _exchanges(plan) == 2  # the distinct count adds the second
    (cols,) = _scan_columns(df)
    assert cols == sorted(["SRC_LOB", "Sent_Date", "Date Message Sent", "Date Failed/Confirmed",
                           "Provider_Directaddress", "NPI Match Status", "Direct Status"])


def test_two_branch_form_needs_a_join_and_more_exchanges(staged):
    plan = _plan(daily_summary_two_branch(staged, "w"))
    assert "Join" in plan and _exchanges(plan) >= 3


def test_detail_needs_no_shuffle(staged):
    assert _exchanges(_plan(normalize_detail(staged, "w"))) == 0


def test_alerts_shuffle_once_and_prune(staged):
    df = low_rate_alerts(staged)
    assert _exchanges(_plan(df)) == 1
    (cols,) = _scan_columns(df)
    assert cols == sorted(["SRC_LOB", "Sent_Date", "Date Message Sent", "NPI Match Status", "Direct Status"])


def test_filters_reach_the_scan(spark, staged):
    from pyspark.sql import functions as F

    plan = _plan(staged.where(F.col("SRC_LOB") == "1-URGENT").select("IDENTIFIER"))
    assert "PushedFilters: [IsNotNull(SRC_LOB), EqualTo(SRC_LOB,1-URGENT)]" in plan
