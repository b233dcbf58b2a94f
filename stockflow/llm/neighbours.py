"""Approximate nearest neighbours by collision counting.

Vectors are dealt into blocks of at most about ``block_rows``, each with an
index of its own, built once: ``projections`` random directions, and for each
of them the block's projections in sorted order. A query looks at every sorted
array through a window centred on its own projection. A vector inside the
window collides with the query in that projection; vectors with at least
``threshold`` of all possible collisions are candidates and are verified by
their exact cosine.

Windows start narrow and widen by ``GROWTH`` (virtual rehashing: the sorted
arrays serve every width, and only what a wider window adds is counted). Their
width is a share of the block's places on either side of the query's. The
search in a block ends when ``effort`` times the square root of the block's
rows have become candidates, a share that falls as blocks grow. This is no cap:
all vectors that have enough collisions by then are verified, and where the
candidates stay fewer, the windows end up covering the block and everything is
verified. Only vectors that collide too seldom for their nearness are missed;
the tests hold recall against brute force.

Each block's k nearest per query are merged by an exact ranking. Every query is
sent to every block, behind the block's vectors, and streamed through its index,
so memory is bounded by the block, however many queries there are.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; only vectors of one length meet; rows repeated with
their id and vector are one candidate; of an id with several vectors the
nearest counts; with fewer than k candidates all are returned; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import materialize

PROJECTIONS = 128
THRESHOLD = 0.36
EFFORT = 9
BLOCK_ROWS = 16_384
SEED = 5
FIRST_WIDTH = 0.1
GROWTH = 1.12


class BlockIndex:
    """Sorted projections of one block of unit vectors."""

    def __init__(self, unit: np.ndarray, ids: np.ndarray, projections: int, seed: int = SEED):
        self.directions = np.random.default_rng(seed).standard_normal((unit.shape[1], projections))
        self.unit = unit
        self.ids = ids
        places = (unit @ self.directions).T
        # one array a projection: which vectors, and where they lie
        self.order = list(np.argsort(places, axis=1))
        self.places = list(np.sort(places, axis=1))
        #: Vectors verified so far, and windows' places counted, over all queries.
        self.verified = self.counted = 0

    def nearest(
        self, queries: np.ndarray, query_ids: np.ndarray, k: int, threshold: float = THRESHOLD, effort: float = EFFORT
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, cosines) of the k nearest found of every query, ties to the smaller id."""
        centres = queries @ self.directions
        at = np.array([np.searchsorted(p, centres[:, j]) for j, p in enumerate(self.places)])
        for m, query in enumerate(queries):
            yield self._search(query, query_ids[m], at[:, m], k, threshold, effort)

    def _search(self, query, query_id, at, k, threshold, effort):
        n, projections = len(self.unit), len(self.order)
        least = int(np.ceil(threshold * projections))
        enough = max(k, effort * n**0.5)
        hits = np.zeros(n, dtype=np.int64)
        open_ = self.ids != query_id
        found, candidates = [], 0
        low, high, width = at.tolist(), at.tolist(), FIRST_WIDTH
        while True:
            reach = int(np.ceil(width * n))
            wider_low, wider_high = np.maximum(at - reach, 0).tolist(), np.minimum(at + reach, n).tolist()
            added = [o[a:b] for o, a, b in zip(self.order, wider_low, low, strict=True)]
            added += [o[a:b] for o, a, b in zip(self.order, high, wider_high, strict=True)]
            added = np.concatenate(added)
            self.counted += len(added)
            hits += np.bincount(added, minlength=n)
            low, high = wider_low, wider_high
            covered = reach >= n
            new = np.flatnonzero(open_ & ((hits >= least) | covered))
            open_[new] = False
            found.append(new)
            candidates += len(new)
            if covered or candidates >= enough:
                break
            width *= GROWTH
        rows = np.concatenate(found)
        self.verified += len(rows)
        # row by row, so that equal vectors get equal cosines
        cosines = (self.unit[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -cosines))[:k]
        return self.ids[rows[best]], cosines[best]


def _unit(vectors: pa.Array) -> np.ndarray:
    """The rows as unit vectors, scaled by their largest component first, so that no square overflows."""
    raw = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Not null, empty or zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    projections: int = PROJECTIONS,
    threshold: float = THRESHOLD,
    effort: float = EFFORT,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k
    nearest rows of ``vectors`` with another id, by cosine."""

    def clean(df: DataFrame, asked: bool) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
        rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).distinct()
        return rows.select("id", "v", F.size("v").alias("dim"), F.lit(asked).alias("asked"))

    ours = materialize(clean(vectors, False))
    blocks = max(1, -(-ours.count() // block_rows))
    own = ours.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    sent = clean(queries, True).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        held: list[pa.RecordBatch] = []
        index: BlockIndex | None = None
        for batch in batches:
            dims, numbers = batch["dim"].to_numpy(), batch["block"].to_numpy()
            asked = batch["asked"].to_numpy(zero_copy_only=False)
            new = (dims[1:] != dims[:-1]) | (numbers[1:] != numbers[:-1]) | (asked[1:] != asked[:-1])
            starts = np.flatnonzero(np.r_[True, new][: len(dims)])
            for s, e in zip(starts, np.r_[starts[1:], len(dims)], strict=True):
                part = batch.slice(int(s), int(e - s))
                if (dims[s], numbers[s]) != at:
                    at, held, index = (dims[s], numbers[s]), [], None
                if not asked[s]:
                    held.append(part)
                    continue
                if index is None and held:
                    block = pa.Table.from_batches(held).combine_chunks()
                    units = _unit(block["v"].combine_chunks())
                    index, held = BlockIndex(units, block["id"].to_numpy(), projections), []
                if index is None:
                    continue
                query_ids = part["id"].to_numpy()
                out = [
                    (np.full(len(found), query_id), found, cosines)
                    for query_id, (found, cosines) in zip(
                        query_ids, index.nearest(_unit(part["v"]), query_ids, k, threshold, effort), strict=True
                    )
                ]
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    together = own.unionByName(sent).repartition("dim", "block").sortWithinPartitions("dim", "block", "asked")
    found = together.mapInArrow(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
