import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockflow.operators import demand
from stockflow.session import materialize

DAY = dt.date(2024, 5, 17)
ROWS = [
    (1, "c1", 10, DAY, "open"),
    (2, "c1", 10, dt.date(2023, 5, 1), "done"),
    (None, "c1", 11, DAY, "open"),
    (4, None, 11, None, None),
    (5, "", None, dt.date(2024, 1, 2), ""),
    (6, None, None, None, "open"),
]
COLUMNS = "OrderID long, CustomerID string, productID long, OrderDate date, status string"

PLAIN = {
    "orders_by_customer": demand.orders_by_customer,
    "orders_by_product": demand.orders_by_product,
    "orders_by_month": demand.orders_by_month,
    "orders_by_status": demand.orders_by_status,
}


@pytest.mark.parametrize("rows", [ROWS, [], ROWS * 50], ids=["rows", "empty", "repeated"])
def test_one_pass_equals_the_four_tables(spark, rows):
    orders = spark.createDataFrame(rows, COLUMNS)
    counts = materialize(demand.order_counts(orders))
    assert set(PLAIN) == set(demand.ORDER_COUNTS)
    total = 0
    for name, plain in PLAIN.items():
        got, want = demand.order_count_table(counts, name), plain(orders)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        total += want.count()
    # nothing but the four tables' rows
    assert counts.count() == total


def test_one_pass_reads_the_orders_once(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame(ROWS, COLUMNS).write.parquet(path)
    plan = demand.order_counts(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" in plan


def test_a_hot_date_is_sorted_in_several_tasks(spark):
    hot = F.when(F.col("id") % 3 > 0, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), -(F.col("id") % 700).cast("int")))
    orders = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("OrderID"), hot.alias("OrderDate"))
    latest = demand.orders_latest_first(orders)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # 60,000 rows are one partition's worth
    try:
        rows = latest.withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = Counter(r.p for r in rows if r.OrderDate == DAY)
    assert len(held) > 2 and max(held.values()) < 20_000
    keys = [(r.OrderDate, -r.OrderID) for r in rows]
    assert keys == sorted(keys, reverse=True)
