"""The schedule from days and parts against the plain window over the listed jobs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stockflow.operators import production

D = dt.date
PARTS = (
    "productID int, FacilityID string, ProcessingTime int, ProcessPartID string, MaterialID string, Req_Prod_Quant int"
)


def _inputs(spark, seed):
    """Products of no, one and two facilities, without parts, without hours, with parts past nine."""
    rng = random.Random(seed)
    days, parts = [], []
    for p in range(40):
        for day in rng.sample(range(70), rng.randint(1, 9)):
            days.append((p, D(2024, 1, 1) + dt.timedelta(days=day), rng.randint(1, 9)))
        if p % 10 == 0:
            continue  # unknown to the parts
        for f in rng.sample(["F1", "F2", "", None], rng.choice([1, 1, 2, 4])):
            n = rng.choice([0, 1, 2, 3, 12])
            hours = lambda: None if rng.random() < 0.2 else rng.randint(3, 5)
            if n == 0:  # one null part, or two alike (others would tie in the queue)
                parts += [(p, f, hours(), None, None, None)] * rng.choice([1, 2])
            parts += [(p, f, hours(), f"{p + 1}_{k}{f or ''}", str(k), k) for k in range(1, n + 1)]
    days += [(None, D(2024, 1, 3), 2), (5, None, 3)]
    rng.shuffle(days), rng.shuffle(parts)
    return production.JobParts(
        spark.createDataFrame(days, "ProductID int, OrderYearMonth date, Delta_produced bigint"),
        spark.createDataFrame(parts, PARTS),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_schedule_from_parts_equals_window(spark, seed):
    jobs = _inputs(spark, seed)
    listed = production.job_list(*jobs)
    for args in ({}, {"rows_per_block": 3}):
        got = production.schedule_jobs(jobs, 8, as_of=D(2024, 1, 15), **args)
        want = production.schedule_jobs(listed, 8, as_of=D(2024, 1, 15), method="window")
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_hot_parts_list_is_cut(spark, monkeypatch):
    jobs = _inputs(spark, 3)
    whole = production._schedule_parts(jobs, 1, 1_000_000)
    monkeypatch.setattr(production, "BROADCAST_PARTS", 0)
    cut = production._schedule_parts(jobs, 1, 1_000_000, hot_rows=4)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))


def test_schedule_does_not_shuffle_the_jobs(spark, monkeypatch):
    """Nothing with a row per job is dealt or sorted: block_pass never sees the jobs."""
    def refuse(*args):
        raise AssertionError("the jobs were shuffled into blocks")

    monkeypatch.setattr(production, "block_pass", refuse)
    days = spark.range(50).select(
        F.lit(1).alias("ProductID"), F.date_add(F.lit(D(2024, 1, 1)), F.col("id").cast("int")).alias("OrderYearMonth"),
        F.lit(2).cast("long").alias("Delta_produced"),
    )
    parts = spark.createDataFrame([(1, "F1", 3, f"2_{k}", str(k), 1) for k in range(1, 9)], PARTS)
    out = production.schedule_jobs(production.JobParts(days, parts), 8, as_of=D(2024, 1, 1))
    assert out.count() == 400
    # 8 parts of 6 hours, 7 switches a day and 49 between days (from part 8 to part 1)
    assert out.agg(F.max("Running_Total")).first()[0] == 50 * (48 + 7) + 49
