import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators.ranking import range_blocks, sequence_number, top_k_per_group


def _skewed(spark):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.4 else rng.randint(1, 30), rng.randint(0, 10_000), i) for i in range(3000)]
    return spark.createDataFrame(rows, "g int, v int, id int")


def test_sequence_number_matches_row_number(spark):
    df = _skewed(spark)
    got = sequence_number(df, ["v", "id"], segment=["g"], name="rn", partitions=6)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(got.select("g", "v", "id", "rn").collect()) == sorted(want.collect())


def test_sequence_number_global(spark):
    df = _skewed(spark)
    got = sequence_number(df, ["id"], name="rn", partitions=5)
    assert sorted((r.id, r.rn) for r in got.collect()) == [(i, i + 1) for i in range(3000)]


def test_top_k_per_group_exact_under_skew(spark):
    df = _skewed(spark).dropDuplicates(["g", "v"])
    got = top_k_per_group(df, ["g"], [F.col("v")], k=3, rank_col="r", salt_buckets=8)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("v"))).where("r <= 3")
    cols = ["g", "v", "r"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_sequence_number_splits_a_common_value(spark):
    df = spark.range(4000).selectExpr("IF(id < 3000, 0, id) AS v", "id")
    got = sequence_number(df, ["v"], name="rn", partitions=8)
    rows = got.collect()
    assert sorted(r.rn for r in rows) == list(range(1, 4001))
    # numbering follows v: every row with v = 0 comes before the others
    assert max(r.rn for r in rows if r.v == 0) == 3000
    tagged = range_blocks(df, [F.col("v"), F.xxhash64("v", "id")], 8)
    assert tagged.where("v = 0").select("_blk").distinct().count() > 1
