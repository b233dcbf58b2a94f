"""Order-grain shuffles are dealt to tasks of a bounded number of rows."""

import pytest

from small_data import SF_SMALL
from stockflow import session
from stockflow.functions import cleaning
from stockflow.operators import joins
from stockflow.plans.registry import Layers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)


def test_tasks_grow_with_the_rows(spark, few_rows):
    assert session.tasks_for(spark, 0) == session.tasks_for(spark, 800) == 8
    assert session.tasks_for(spark, 801) == 9


def test_duplicates_are_aggregated_after_the_rows_are_dealt(spark, few_rows):
    rows = [(i % 1500, f"x{i % 1500}") for i in range(2000)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "a int, b string")
    plan = _plan(cleaning.remove_duplicate_rows(df, rows=len(rows)))
    # one exchange of 21 tasks, below both halves of the aggregate
    assert plan.count("Exchange ") == 1 and "hashpartitioning(a#" in plan and ", 21), REPARTITION_BY_NUM" in plan
    assert plan.rindex("HashAggregate") < plan.index("Exchange ")
    got = cleaning.remove_duplicate_rows(df, rows=len(rows)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, df.distinct().collect())) and len(got) == 1501


def test_orders_of_a_join_task_are_bounded(spark, few_rows):
    left = spark.createDataFrame([(i % 7 if i % 9 else None, i) for i in range(2000)], "k int, v int")
    right = spark.createDataFrame([(i, i * 10) for i in range(5)], "rk int, w int")
    args = (["k"], ["rk"], ["k", "v", "w"], 50)
    bounded = joins.left_join_hot_left(left, right, *args, rows=2000)
    assert ", 20), REPARTITION_BY_NUM" in _plan(bounded)
    assert sorted(map(repr, bounded.collect())) == sorted(map(repr, joins.left_join_hot_left(left, right, *args).collect()))


def test_raw_orders_and_their_dedupe_are_dealt_by_the_line_count(spark, few_rows):
    l = Layers(spark, SF_SMALL)
    n = session.tasks_for(spark, l.order_lines())
    assert n == 60
    assert _plan(l.raw("customer_orders")).count(f", {n}), REPARTITION_BY_NUM") == 1
    assert _plan(l.orders()).count(f", {n}), REPARTITION_BY_NUM") == 2
