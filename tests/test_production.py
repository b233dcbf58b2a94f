import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stockflow.functions.derived import safety_stock
from stockflow.operators import inventory, production

D = dt.date
JOB_SCHEMA = (
    "ProductID int, OrderYearMonth date, Delta_produced bigint, MaterialID string, ProcessPartID string,"
    " Req_Prod_Quant int, FacilityID string, ProcessingTime int"
)


def test_safety_stock(spark):
    df = spark.createDataFrame([(49,), (50,), (51,), (None,)], "inv int")
    assert [r.s for r in df.select(safety_stock(F.col("inv")).alias("s")).collect()] == [0, 0, 1, None]


def test_missing_inventory_fills_and_subtracts(spark):
    demand = spark.createDataFrame(
        [(1, "open"), (1, "open"), (1, "closed"), (2, "open")], "productID int, status string"
    )
    domain = spark.createDataFrame(
        [(1, 120), (1, 120), (2, None), (3, 40)], "productID int, Product_Inventory int"
    )
    rows = {r.productID: r for r in inventory.missing_inventory(demand, domain).collect()}
    assert (rows[1].ProductsOrdered, rows[1].Product_Inventory, rows[1].Difference) == (2, 70, 68)
    assert (rows[2].ProductsOrdered, rows[2].Product_Inventory, rows[2].Difference) == (1, 0, -1)
    assert (rows[3].ProductsOrdered, rows[3].Product_Inventory, rows[3].Difference) == (0, 0, 0)
    assert len(rows) == 3


def test_inventory_rundown_example(spark):
    per_day = spark.createDataFrame(
        [(7, D(2024, 1, 1), 3), (7, D(2024, 1, 2), 3), (7, D(2024, 1, 3), 4), (8, D(2024, 1, 1), 9)],
        "ProductID int, OrderYearMonth date, count bigint",
    )
    missing = spark.createDataFrame([(7, 5)], "ProductID int, Product_Inventory int")
    out = production.inventory_rundown(per_day, missing)
    rows = [r for r in out.orderBy("ProductID", "OrderYearMonth").collect()]
    p7 = [r for r in rows if r.ProductID == 7]
    assert [r.end_inventory for r in p7] == [2, 0, 0]
    assert [r.start_inventory for r in p7] == [5, 2, 0]
    assert [r.Total_produced for r in p7] == [0, 1, 5]
    assert [r.Delta_produced for r in p7] == [0, 1, 4]
    jobs = production.production_deltas(out).orderBy("OrderYearMonth").collect()
    assert [(r.ProductID, r.Delta_produced) for r in jobs] == [(7, 1), (7, 4)]  # unknown product 8: no job


def _jobs(spark, rows):
    return spark.createDataFrame(rows, JOB_SCHEMA)


@pytest.mark.parametrize("method", ["window", "blocks"])
def test_schedule_example(spark, method):
    jobs = _jobs(spark, [(1, D(2024, 11, 30), 2, "10", "1_1", 1, "F1", 3), (1, D(2024, 11, 30), 2, "11", "1_2", 1, "F1", 3)])
    out = production.schedule_jobs(jobs, 8, as_of=D(2024, 12, 1), method=method).orderBy("ProcessPartID").collect()
    assert [r.TotalProcessingTime for r in out] == [6, 7]
    assert [r.Running_Total for r in out] == [13, 13]
    assert out[0].OrderDeadline == D(2025, 2, 28)
    assert out[0].DiffHours == (D(2025, 2, 28) - D(2024, 12, 1)).days * 8


@pytest.mark.parametrize("method", ["window", "blocks"])
def test_schedule_null_part_adds_switch_cost(spark, method):
    jobs = _jobs(spark, [(1, D(2024, 1, 1), 2, None, None, None, "F1", 3)])
    row = production.schedule_jobs(jobs, 8, as_of=D(2024, 1, 1), method=method).first()
    assert row.TotalProcessingTime == 7


def _schedule_frame(spark, delays):
    rows = [(i, D(2024, 1, 1), 1, "F1", D(2024, 4, 1), d + 100, 100) for i, d in enumerate(delays)]
    return spark.createDataFrame(
        rows, "ProductID int, OrderYearMonth date, Delta_produced bigint, FacilityID string, OrderDeadline date,"
        " Running_Total bigint, DiffHours int",
    )


def test_delay_categories(spark):
    alerts = production.delay_alerts(_schedule_frame(spark, [1, 21, 41, 61, 81, 101]))
    got = [r.DelayCategory for r in alerts.orderBy("ExpectedDelay").collect()]
    assert got == ["Category_1", "Category_1", "Category_2", "Category_3", "Category_4", "Category_5"]


def test_delay_categories_equal_and_empty(spark):
    same = production.delay_alerts(_schedule_frame(spark, [7, 7, 7]))
    assert {r.DelayCategory for r in same.collect()} == {"Category_1"}
    none_late = production.delay_alerts(_schedule_frame(spark, [0, -5]))
    assert none_late.collect() == []


def _random_jobs(seed, n_products=60, n_days=12):
    rng = random.Random(seed)
    facilities = ["F1", "F2", "F3", None]
    rows = []
    for p in range(n_products):
        fac = rng.choice(facilities)
        pt = None if rng.random() < 0.05 else rng.randint(3, 5)
        n_parts = rng.choice([0, 1, 2, 3, 4])
        for day in rng.sample(range(n_days), rng.randint(1, 6)):
            delta = rng.randint(1, 9)
            if n_parts == 0:
                rows.append((p, D(2024, 1, 1) + dt.timedelta(days=day), delta, None, None, None, fac, pt))
            for k in range(1, n_parts + 1):
                rows.append((p, D(2024, 1, 1) + dt.timedelta(days=day), delta, str(100 + k), f"{p + 1}_{k}", k, fac, pt))
    # a few jobs with unknown product or day (they sort first in the queue)
    rows.append((None, D(2024, 1, 3), 2, "101", "x_1", 1, "F1", 3))
    rows.append((None, D(2024, 1, 3), 2, None, None, None, "F2", 4))
    rows.append((5, None, 3, "102", "6_2", 2, "F1", 5))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocks_equal_window(spark, seed):
    rows = _random_jobs(seed)
    rng = random.Random(seed)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    jobs = _jobs(spark, rows)
    expected = sorted(production.schedule_jobs(jobs, 8, as_of=D(2024, 1, 15), method="window").collect(), key=repr)
    for rows_per_block in (1, 3, 1_000_000):
        got = production.schedule_jobs(
            _jobs(spark, shuffled), 8, as_of=D(2024, 1, 15), method="blocks", rows_per_block=rows_per_block
        )
        assert sorted(got.collect(), key=repr) == expected


def test_busy_day_is_split_into_ranges(spark):
    rows = [(p, D(2024, 1, 1), 1, "1", f"{p + 1}_1", 1, "F1", 3) for p in range(100)]
    rows += [(p, D(2024, 1, 2), 1, "1", f"{p + 1}_1", 1, "F1", 3) for p in range(5)]
    keyed = production.assign_schedule_blocks(_jobs(spark, rows), rows_per_block=10)
    subs = {r[0]: r[1] for r in keyed.groupBy("OrderYearMonth").agg(F.countDistinct("_sub")).collect()}
    assert subs[D(2024, 1, 1)] == 10 and subs[D(2024, 1, 2)] == 1
    sizes = [r[1] for r in keyed.groupBy("OrderYearMonth", "_sub").count().collect()]
    assert max(sizes) <= 10


def test_alerts_same_without_materialize(spark):
    rows = _random_jobs(4)
    sched = production.schedule_jobs(_jobs(spark, rows), 8, as_of=D(2024, 1, 3))
    a = sorted(production.delay_alerts(sched).collect(), key=repr)
    b = sorted(production.delay_alerts(sched, materialize=False).collect(), key=repr)
    assert a == b and len(a) > 0
