"""A left outer join whose hot keys are split, whichever side they are on.

AQE's skew handling splits an oversized join partition only when both join
inputs are fresh shuffles and only on a side whose rows may be duplicated
(for a left outer join: the left side). A key that is hot on the right (one
process with a third of all parts), or a left input that arrives already
partitioned (the output of a window), stays in one task. So the split is
made explicit: hot keys are cut into pieces, one side's rows are spread over
the pieces by a row hash, the other side's rows are repeated once per piece,
and one left outer join runs on (key, piece).

The table of hot keys is broadcast and has at most ``HOT_KEYS`` rows however
large the input is: the most common keys with more than ``hot_rows`` rows. A
key that is not in it holds at most max(hot_rows, all rows / HOT_KEYS) rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.session import deal, tasks_for

PIECE = "_piece"
PIECES = "_pieces"
#: Column of a counted DataFrame: how many rows one of its rows stands for.
ROWS = "_rows"
#: Most rows of a broadcast hot-key table.
HOT_KEYS = 10_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """(keys, pieces): the ``HOT_KEYS`` most common of the non-null keys with
    more than ``hot_rows`` rows, and into how many pieces each is cut. A row of
    ``df`` counts as many as its ``_rows`` column says, if there is one."""
    rows = F.sum(ROWS) if ROWS in df.columns else F.count(F.lit(1))
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(rows.alias("_rows"))
    common = counts.where(F.col("_rows") > hot_rows).orderBy(F.desc("_rows"), *keys).limit(HOT_KEYS)
    return F.broadcast(common.select(*keys, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias(PIECES)))


def _equal(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[a] == right[b] for a, b in zip(left_keys, right_keys, strict=True)])


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def _with_pieces(df: DataFrame, keys: Sequence[str], hot: DataFrame, hot_names: Sequence[str]) -> DataFrame:
    """``df`` with the number of its key's pieces, null for a key that isn't hot."""
    renamed = reduce(lambda h, c: h.withColumnRenamed(c, f"_h_{c}"), hot_names, hot)
    held = [f"_h_{c}" for c in hot_names]
    return df.join(renamed, _equal(df, renamed, keys, held), "left").drop(*held)


def _row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def _spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row in one piece of its key, by a hash of the row."""
    pieces = F.coalesce(F.col(PIECES), F.lit(1))
    return df.withColumn(PIECE, F.pmod(_row_hash(columns), pieces).cast("int")).drop(PIECES)


def left_join_skew_safe(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    output: Sequence[str],
    hot_rows: int = 1_000_000,
    counted: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``left`` LEFT OUTER JOIN ``right`` on left_keys[i] = right_keys[i];
    returns the ``output`` columns (unmatched rows get nulls for right columns).

    Column names must not collide between the sides (rename right keys first).
    A right key with more than ``hot_rows`` rows is cut into pieces, and its
    left rows are repeated once per piece. Such a left row always has matches;
    where one of its pieces holds none, the null row of that piece is dropped.
    Each side is read once, besides the count of the right keys. ``counted``
    may name another DataFrame with the right keys, cheaper to read, to count
    them in: the counts decide how work is split, never what matches. Left rows
    with a null key get a negative piece by row hash: they match nothing and
    lie spread over all partitions. With ``rows``, about how many rows ``right``
    has, they are dealt to tasks of a bounded number of rows.
    """
    hot = hot_keys(right if counted is None else counted, right_keys, hot_rows)
    right_pieces = _spread(
        _with_pieces(right.dropna(subset=list(right_keys)), right_keys, hot, right_keys), right.columns
    ).withColumn("_matched", F.lit(True))
    if rows is not None:
        right_pieces = deal(right_pieces, rows, *right_keys, PIECE)

    left_hot = _with_pieces(left, left_keys, hot, right_keys)
    here = F.when(_any_null(left_keys), F.array(-1 - F.pmod(_row_hash(left.columns), F.lit(1 << 20)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)
    )
    left_pieces = left_hot.withColumn("_left_piece", F.explode(here))
    on = _equal(left_pieces, right_pieces, left_keys, right_keys) & (F.col("_left_piece") == F.col(PIECE))
    joined = left_pieces.join(right_pieces, on, "left")
    return joined.where(F.col(PIECES).isNull() | F.col("_matched")).select(*output)


def left_join_hot_left(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    output: Sequence[str],
    hot_rows: int = 1_000_000,
    counted: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``left`` LEFT OUTER JOIN ``right`` when a key may be hot on the left
    (one customer with a large share of all orders) and each key has few
    right rows (a master table).

    Left keys with more than ``hot_rows`` rows are cut into pieces: their left
    rows are spread over the pieces by a row hash, and the right rows of those
    keys are repeated once per piece. Every left row then meets all of its
    right rows exactly once, so a plain left join on (key, piece) is the left
    outer join. ``counted`` may name another DataFrame with the left keys,
    cheaper to read than ``left``, to count them in: the counts decide how
    work is split, never what matches. Left rows with a null key get a negative
    piece by row hash: they match nothing and lie spread over all partitions.
    With ``rows``, about how many rows ``left`` has, they are dealt to tasks of
    a bounded number of rows.
    """
    hot = hot_keys(left if counted is None else counted, left_keys, hot_rows)
    left_hot = _with_pieces(left, left_keys, hot, left_keys)
    row = _row_hash(left.columns)
    mine = F.when(_any_null(left_keys), -1 - F.pmod(row, F.lit(1 << 20))).otherwise(
        F.pmod(row, F.coalesce(F.col(PIECES), F.lit(1)))
    )
    left_pieces = left_hot.withColumn("_left_piece", mine.cast("int")).drop(PIECES)
    if rows is not None:
        left_pieces = left_pieces.repartition(tasks_for(left.sparkSession, rows), *left_keys, "_left_piece")
    right_pieces = (
        _with_pieces(right, right_keys, hot, left_keys)
        .withColumn(PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)))
        .drop(PIECES)
    )
    on = _equal(left_pieces, right_pieces, left_keys, right_keys) & (F.col("_left_piece") == F.col(PIECE))
    return left_pieces.join(right_pieces, on, "left").select(*output)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on same-named keys where null matches null (``<=>``); the right
    side's copies of the keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
