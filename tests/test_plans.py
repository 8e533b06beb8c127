"""Physical-plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as E

from tests.settings import SMALL

QUERIES = E.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_date_range_reaches_the_scan(spark):
    plan = _formatted(QUERIES["ma_date_range"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,", plan)


def test_lines_pruned_and_pre_aggregated_before_join(spark):
    plan = _formatted(QUERIES["retail_daily_status_revenue"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    assert plan.count("HashAggregate") >= 4  # per-order partial/final, then per-day partial/final


def test_bucketed_join_needs_no_exchange(spark):
    plan = _plan(QUERIES["sink_bucketed"](spark, SMALL))
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "BatchEvalPython" not in plan
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
