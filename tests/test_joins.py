import random

from pyspark.sql import functions as F

from stockflow.operators.joins import left_join_hot_left, left_join_skew_safe


def test_left_join_skew_safe_equals_left_join(spark):
    rng = random.Random(11)
    left_rows = [(rng.choice([None, 0, 1, 2, 3, 4]), i) for i in range(300)]
    # key 0 is hot on the right; key 4 never appears on the right
    right_rows = [(0 if rng.random() < 0.5 else rng.choice([None, 1, 2, 3, 9]), f"r{j}") for j in range(200)]
    left = spark.createDataFrame(left_rows, "k int, a int")
    right = spark.createDataFrame(right_rows, "rk int, b string")
    want = left.join(right, left.k == right.rk, "left").select("k", "a", "b")
    expected = sorted(want.collect(), key=repr)
    for hot_rows in (1_000_000, 30, 7):  # no hot key; key 0 hot; several hot keys
        got = left_join_skew_safe(left, right, ["k"], ["rk"], ["k", "a", "b"], hot_rows=hot_rows)
        assert got.dtypes == want.dtypes
        assert sorted(got.collect(), key=repr) == expected


def test_null_keys_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).selectExpr("CAST(NULL AS int) AS k", "id AS a")
        right = spark.createDataFrame([(1, "x"), (None, "n")], "rk int, b string")
        for join in (left_join_skew_safe, left_join_hot_left):
            got = join(left, right, ["k"], ["rk"], ["k", "a", "b"])
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4000 and len(sizes) > 2 and max(sizes) < 2000
            assert got.where("b IS NOT NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_skew_safe_join_reads_the_left_side_once(spark):
    left = spark.range(50).selectExpr("CAST(id AS int) AS k", "id AS a")
    right = spark.range(70).selectExpr("CAST(id % 9 AS int) AS rk", "id AS b")
    plan = left_join_skew_safe(left, right, ["k"], ["rk"], ["k", "a", "b"], hot_rows=3)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Range (0, 50") == 1


def test_left_join_hot_left_equals_left_join(spark):
    rng = random.Random(12)
    # key 0 is hot on the left; the right side is a master table with a duplicate key 2
    left_rows = [(0 if rng.random() < 0.4 else rng.choice([None, 1, 2, 3, 4]), i) for i in range(400)]
    right_rows = [(0, "zero"), (1, "one"), (2, "two"), (2, "two-b"), (None, "null"), (9, "nine")]
    left = spark.createDataFrame(left_rows, "k int, a int")
    right = spark.createDataFrame(right_rows, "rk int, b string")
    want = left.join(right, left.k == right.rk, "left").select("k", "a", "b")
    expected = sorted(want.collect(), key=repr)
    for hot_rows in (1_000_000, 50, 9):
        got = left_join_hot_left(left, right, ["k"], ["rk"], ["k", "a", "b"], hot_rows=hot_rows)
        assert got.dtypes == want.dtypes
        assert sorted(got.collect(), key=repr) == expected
