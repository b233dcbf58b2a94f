"""Ordered numbering that stays parallel when groups are huge or absent.

A plain ``row_number().over(Window.partitionBy(g).orderBy(o))`` sends each
group to one task, and with no partition key it sends the whole table to one
task. The two operators here keep the work spread out:

* ``top_k_per_group``: a salted two-step top-k. A hot group is first cut into
  ``salt_buckets`` pieces, each keeps its own k best rows, then at most
  ``salt_buckets * k`` rows per group are ranked again. The result is exact.
* ``sequence_number``: numbering in a global (or per-segment) order. Rows are
  range-partitioned on (segment, order) so that every block holds a contiguous
  slice of the order, numbered locally; the counts of earlier blocks are
  prefix-summed and added back. Only a block's first segment can continue
  from earlier blocks, so the added offsets form a table of at most one row
  per block, broadcast with that bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.operators.joins import join_null_safe
from stockflow.session import materialize

BLOCK = "_blk"


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top_k_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    k: int,
    rank_col: str = "rank",
    salt_buckets: int = 16,
) -> DataFrame:
    """The first ``k`` rows of every group in ``order_cols`` order, numbered 1..k."""
    order = _cols(order_cols)
    salt = F.pmod(F.xxhash64(*order), F.lit(salt_buckets))
    salted = df.withColumn("_salt", salt)
    w_piece = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    firsts = (
        salted.withColumn("_piece_rank", F.row_number().over(w_piece))
        .where(F.col("_piece_rank") <= k)
        .drop("_piece_rank", "_salt")
    )
    w_group = Window.partitionBy(*group_cols).orderBy(*order)
    return firsts.withColumn(rank_col, F.row_number().over(w_group)).where(F.col(rank_col) <= k)


def range_blocks(df: DataFrame, keys: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Range-partition on ``keys`` and tag each row with its block number.

    Blocks are contiguous, increasing slices of the key order; the sampler
    balances them even when one key value is very common. The tagged result
    is checkpointed by the callers because the block number is only stable
    for one physical execution of the range exchange.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *_cols(keys)).withColumn(BLOCK, F.spark_partition_id())


def join_on_blocks(rows: DataFrame, blocks: DataFrame, segment: Sequence[str]) -> DataFrame:
    """Attach per-block values to rows. Segment keys may be null, so the
    join is null-safe; ``blocks`` has one row per (block, segment)."""
    return join_null_safe(rows, blocks, [BLOCK, *segment])


def sequence_number(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    segment: Sequence[str] = (),
    name: str = "row_number",
    partitions: int | None = None,
    drop_shuffles: bool = False,
) -> DataFrame:
    """``row_number()`` over (PARTITION BY segment ORDER BY order_cols), as long,
    without funnelling a segment (or the whole table) through one task.

    Rows that tie on ``order_cols`` have no defined order under row_number; a
    hash of the whole row orders them, so a very common order value is also
    spread over several blocks (only identical rows stay together). If segment
    and order hold every column, rows that tie are identical, and the hash is
    left out: it would tell them apart no better.
    ``drop_shuffles``: see ``materialize``.
    """
    order = _cols(order_cols)
    named = {c for c in [*segment, *order_cols] if isinstance(c, str)}
    if not named.issuperset(df.columns):
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    blocked = range_blocks(df, [*segment, *order], partitions)
    w_local = Window.partitionBy(BLOCK, *segment).orderBy(*order)
    local = materialize(blocked.withColumn("_local", F.row_number().over(w_local)), drop_shuffles)
    counts = local.groupBy(BLOCK, *segment).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*segment).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # Rows are range-partitioned on (segment, order), so only the first
    # segment of a block can have rows in earlier blocks: at most one row per
    # block has a positive offset. That table (<= number of blocks rows) is
    # broadcast; every other row's offset is 0.
    offsets = (
        counts.select(BLOCK, *segment, F.sum("_cnt").over(before).alias("_off"))
        .where(F.col("_off") > 0)
    )
    out = join_on_blocks(local, F.broadcast(offsets), segment)
    number = F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))
    return out.withColumn(name, number.cast("long")).drop(BLOCK, "_local", "_off")
