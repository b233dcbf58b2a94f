"""Sampled-splitter sharding (DataFrame functions only).

Records get the key (text hash, document id, row number) and are dealt into
contiguous key ranges of nearly equal bytes:

1. draw a sample in which a record's chance follows its size;
2. take the sample's quantiles as splitters of ``shards * ranges_per_shard``
   key ranges, so a range holds about the same bytes whatever the keys are;
3. measure every range exactly; a range with more than twice the mean (the
   sample missed a hot text or a huge record) is subdivided by row number;
4. running sums inside each (sub)range plus the exact bytes before it give
   every record its place in the whole key order, and the place gives the
   shard: the shard in whose 1/n of all bytes the middle of the record lies.

So a shard's bytes differ from the mean by less than the largest record, and
no window ever sees more than about two mean ranges. Copies of a text are
neighbours in key order: they share a shard unless a shard's edge, or the
subdivision of an overfull range, falls between them.

Defined cases: null text is empty text (size 1, CRC of no bytes); null ids
sort first and are kept; repeated rows are separate records; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import materialize, unused

MIN_LONG = -(2**63)
KEY = ("_h", "_id", "_row")


def shard_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The narrow record table: id, size in bytes plus one, CRC and sort key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_h"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_LONG)).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
    )


def sample_splitters(records: DataFrame, total: int, ranges: int, per_range: int, seed: int) -> list[tuple]:
    """``ranges - 1`` (or fewer) keys that cut the records into ranges of
    about equal bytes. About ``ranges * per_range`` keys reach the driver,
    whatever the size of the input."""
    want = ranges * per_range
    share = F.col("size") * F.lit(want / max(total, 1))
    drawn = (
        records.where(F.rand(seed) < share).select(*KEY, F.greatest(share, F.lit(1.0)).alias("_w")).collect()
    )
    drawn.sort()
    if not drawn:
        return []
    ends = list(accumulate(r["_w"] for r in drawn))
    picks = {bisect_right(ends, ends[-1] * i / ranges) for i in range(1, ranges)}
    return [tuple(drawn[i][:3]) for i in sorted(picks) if i < len(drawn)]


def _at_or_after(s: Column) -> Column:
    h, i, r = (F.col(c) for c in KEY)
    return (s["h"] < h) | ((s["h"] == h) & ((s["i"] < i) | ((s["i"] == i) & (s["r"] <= r))))


def _splitter(s: tuple) -> Column:
    return F.struct(F.lit(s[0]).alias("h"), F.lit(s[1]).alias("i"), F.lit(s[2]).alias("r"))


def _count_up_to(splitters: list[tuple]) -> Column:
    """How many of the splitters are at or before the row's key."""
    if not splitters:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(_splitter, splitters)), _at_or_after))


def range_of(splitters: list[tuple], width: int) -> Column:
    """Number of splitters at or before the row's key, in two steps: first
    among every ``width``-th, then among those that follow it."""
    coarse = splitters[width - 1 :: width]
    if not coarse:
        return _count_up_to(splitters)
    fine = [splitters[k * width : k * width + width - 1] for k in range(len(coarse) + 1)]
    which = _count_up_to(coarse)
    inner = F.coalesce(*[F.when(which == k, _count_up_to(f)) for k, f in enumerate(fine)])
    return which * width + inner


def assign_shards(
    records: DataFrame,
    shards: int = 16,
    ranges_per_shard: int = 16,
    samples_per_range: int = 32,
    seed: int = 17,
) -> DataFrame:
    """Add ``shard`` (0-based), ``slot`` (place in the shard, gapless from 0)
    to the output of ``shard_records``; bytes are near equal."""
    records = materialize(records)
    ranges = shards * ranges_per_shard
    total = records.agg(F.sum("size").alias("b")).first()["b"] or 0
    splitters = sample_splitters(records, total, ranges, samples_per_range, seed)
    ranged = materialize(records.withColumn("_range", range_of(splitters, ranges_per_shard)))

    # At most one row per range; an overfull range gets as many parts as it
    # holds mean ranges, so at most 2 * ranges parts exist.
    mean = max(1, -(-total // ranges))
    parts = ranged.groupBy("_range").agg(
        F.when(F.sum("size") > 2 * mean, F.ceil(F.sum("size") / mean)).otherwise(1).cast("long").alias("_parts")
    )
    split = ranged.join(F.broadcast(parts), "_range").withColumn(
        "_part", F.pmod(F.xxhash64("_row"), F.col("_parts"))
    )
    block = ["_range", "_part"]
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    sums = split.groupBy(*block).agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    starts = sums.select(
        *block,
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
    )
    inside = Window.partitionBy(*block).orderBy(*KEY)
    place = F.col("_byte0") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = split.join(F.broadcast(starts), block).select(
        *[c for c in records.columns if c not in KEY],
        (F.col("_row0") + F.row_number().over(inside) - 1).alias("_at"),
        place.alias("_end"),
    )
    middle = 2 * F.col("_end") - F.col("size")
    placed = materialize(
        placed.withColumn(
            "shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * max(total, 1)))).cast("int")
        ).drop("_end")
    )
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_at") - F.col("_first"))
        .drop("_at", "_first")
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the documents themselves, one folder per shard, in slot order;
    returns the plan. Ids must be unique for the join back to the texts."""
    plan = assign_shards(shard_records(docs, id_col, text_col), **options)
    docs = docs.drop("shard", "slot")
    name = unused(docs, "plan_id")
    place = plan.select(F.col("doc_id").alias(name), "shard", "slot")
    rows = docs.join(place, F.col(id_col) == F.col(name)).drop(name)
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.mode(
        "overwrite"
    ).partitionBy("shard").parquet(path)
    return plan
