"""What a query stores and shuffles is cut to what its steps read."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from small_data import SF_SMALL
from stockflow import session
from stockflow.operators import inventory, joins, production, silver
from stockflow.plans import registry
from stockflow.plans.registry import Layers
from stockflow.sources import fixtures


def _plan(df, mode="simple") -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(mode)


def _rows(df) -> list:
    return sorted(df.collect(), key=repr)


@pytest.fixture
def stored(monkeypatch):
    """Columns and row counts of what the layers store, in order."""
    found = []

    def record(df, *args, **kwargs):
        out = session.materialize(df, *args, **kwargs)
        found.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(registry, "materialize", record)
    return found


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)


def _shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(str(d)) for f in files if f.startswith("shuffle_")}


def test_missing_inventory_stores_no_domain(spark, stored):
    l = Layers(spark, SF_SMALL)
    top = inventory.top_missing_inventory(l.missing_inventory())
    # one row per product, two columns; nothing of the orders
    assert stored == [(["productID", "Product_Inventory"], 200)]
    whole = inventory.missing_inventory(session.materialize(l.demand_domain()), session.materialize(l.manufacturing_domain()))
    assert top.collect() == inventory.top_missing_inventory(whole).collect() and top.count() == 100
    assert _rows(l.missing_inventory()) == _rows(whole)


def test_only_open_orders_are_shuffled_for_missing_inventory(spark):
    plan = _plan(Layers(spark, SF_SMALL).missing_inventory(), "formatted")
    # filtered where the lines are read, before any shuffle of them
    scan, condition = plan.index("l_linestatus"), re.search(r"Condition : .*\(l_linestatus#\d+ = O\)", plan)
    assert condition and "Exchange\n" not in plan[scan : condition.start()]


def test_rundown_stores_open_orders_once_and_narrow(spark, stored):
    l = Layers(spark, SF_SMALL)
    got = _rows(l.rundown())
    assert stored[0] == (["productID", "OrderDate", "status"], l.demand_domain().where("status = 'open'").count())
    assert [c for c, _ in stored[1:]] == [["productID", "Product_Inventory"]]
    per_day = production.open_orders_by_product_day(l.current_demand())
    assert got == _rows(production.inventory_rundown(per_day, l.missing_inventory()))


def test_shuffles_of_a_stored_frame_are_dropped(spark):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before, setting = _shuffle_files(spark), spark.conf.get(session.DROP_SHUFFLES)
    kept = session.materialize(df)
    assert _shuffle_files(spark) - before
    before = _shuffle_files(spark)
    out = session.materialize(df, drop_shuffles=True)
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.DROP_SHUFFLES) == setting
    # both copies and the frame itself can still be read
    assert _rows(out) == _rows(kept) == _rows(df) and len(_rows(out)) == 10


def test_orders_counted_per_customer_without_building_them(spark):
    raw = fixtures.raw_customer_orders(spark, SF_SMALL)
    counted = fixtures.order_customers(spark, SF_SMALL)
    assert _rows(counted.groupBy("CustomerID").agg(F.sum("_rows"))) == _rows(raw.groupBy("CustomerID").count())
    for hot_rows in (1, 30, 1_000_000):
        hot = joins.hot_keys(counted, ["CustomerID"], hot_rows)
        assert _rows(hot) == _rows(joins.hot_keys(raw, ["CustomerID"], hot_rows))
    l = Layers(spark, SF_SMALL)
    split = silver.demand_domain(l.orders(), l.customers(), hot_rows=30, counted=counted)
    assert _rows(split) == _rows(silver.demand_domain(l.orders(), l.customers()))


def test_parts_of_a_task_are_bounded(spark, few_rows):
    l = Layers(spark, SF_SMALL)
    n = session.tasks_for(spark, l.order_lines())
    assert n == 60
    assert f", {n}), REPARTITION_BY_NUM" in _plan(l.parts())
    # the dedupe of the parts and their join with the processes
    assert _plan(l.manufacturing_domain()).count(f", {n}), REPARTITION_BY_NUM") == 2


def test_right_rows_of_a_skew_safe_join_task_are_bounded(spark, few_rows):
    left = spark.createDataFrame([(i, i * 10) for i in range(9)] + [(None, 1)], "k int, v int")
    right = spark.createDataFrame([(i % 7 if i % 9 else None, i) for i in range(2000)], "rk int, w int")
    for hot_rows in (50, 1_000_000):
        args = (["k"], ["rk"], ["k", "v", "w"], hot_rows)
        bounded = joins.left_join_skew_safe(left, right, *args, rows=2000)
        assert ", 20), REPARTITION_BY_NUM" in _plan(bounded)
        assert _rows(bounded) == _rows(joins.left_join_skew_safe(left, right, *args))
    # few rows are left to the planner
    assert "REPARTITION_BY_NUM" not in _plan(joins.left_join_skew_safe(left, right, *args, rows=800))


def test_job_list_stores_no_jobs(spark, stored):
    jobs = registry.QUERIES["job_list"](spark, SF_SMALL)
    # the parts (1905) with what the jobs take from them, the open orders (2979) and the stock of 200 products
    assert stored == [
        ([*production.PART_COLUMNS, "Product_Inventory"], 1905), (["productID", "OrderDate", "status"], 2979),
        (["productID", "Product_Inventory"], 200),
    ]
    l = Layers(spark, SF_SMALL)
    whole = production.job_list(l.deltas(), inventory.inventory_table(session.materialize(l.manufacturing_domain())))
    assert jobs.columns == production.JOB_COLUMNS and jobs.count() == 12555
    assert _rows(jobs) == _rows(whole) == _rows(l.jobs())


def test_parts_of_a_job_list_task_are_bounded(spark, few_rows):
    l = Layers(spark, SF_SMALL)
    n = session.tasks_for(spark, l.order_lines())
    assert f", {n}), REPARTITION_BY_NUM" in _plan(l.job_list())
