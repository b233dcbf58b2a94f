"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits are linked when at most ``max_bits`` (4) bits differ.
They are cut into ``max_bits // 2 + 1`` (3) segments, fewer than the bits that
may differ, so that of any linked pair one segment differs by at most one bit.
Every segment is indexed under its variants with one bit deleted (a wildcard):
two segments that differ in at most that bit share the variant. An equality
join on (segment, deleted bit, remaining bits) therefore finds every link, and
each candidate is verified on the whole fingerprints.

Groups of copies cost little. Equal texts have one fingerprint and go through
as one row. Near copies with many different fingerprints crowd into the same
variants; a variant's members are therefore not compared in all pairs but
searched breadth first: a member is compared only with those that have no class
yet, and each member found gives one link, so a variant of n members gives at
most n - 1 links however dense it is. Variants with more than ``crowded``
members are dealt into blocks, and every two blocks meet in a group of their
own, so no task holds more than two blocks of a variant. (Which variants are
crowded is estimated from a fixed sixteenth of the fingerprints; the estimate
decides how work is dealt and never what is compared.)

Classes are joined by alternating star contraction on distributed edge tables
(checkpointed in ``spark.checkpoint.dir``); no links or fingerprints reach the
driver.

Defined cases: null text is empty text; a text without words has fingerprint
zero and is linked like any other; with fewer words than a shingle the whole
sequence is the one shingle; repeated rows share a class; a class's id is its
smallest non-null document id (null if it has none); an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text, materialize, unused
from stockflow.operators.joins import left_join_hot_left

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Members from which a variant is dealt into blocks of at most about that many.
CROWDED = 4096
#: Most crowded variants there can be, so that their table can be broadcast.
CROWDED_TABLE = 50_000
#: Share of fingerprints (one in so many) that the crowding estimate reads.
ESTIMATE = 16
#: Rows of a class or fingerprint from which its joins are cut into pieces.
HOT_ROWS = 1_000
#: Longest variant that is compared in all pairs, and rows compared at once.
SHORT_RUN = 32
ROWS_AT_ONCE = 512
#: Shingle hashes whose bits are counted at once (bounds memory on long texts).
HASHES_AT_ONCE = 1 << 16
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    found = _WORDS.findall(text.encode().lower())  # bytes.lower is A-Z only
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = list(accumulate(len(w) + 1 for w in found))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[words - 1 :], strict=False)]
    return np.array(hashes, dtype=np.uint64)


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint, unsigned: a bit is 1 if set in over half the hashes."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[k : k + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t.as_py(), words) for t in batch["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# -- links ------------------------------------------------------------------


def segments(max_bits: int) -> list[tuple[int, int]]:
    """For two differing bits or more: (first bit, bits) of the fewest segments one of which must differ by
    at most one bit when ``max_bits`` differ in all."""
    n = max_bits // 2 + 1
    edges = [-(-BITS * k // n) for k in range(n + 1)]
    return [(s, e - s) for s, e in zip(edges, edges[1:], strict=False)]


def variant_keys(fp, max_bits: int = MAX_BITS):
    """Array of the one-wildcard variants: the deleted bit's number above the
    segment's remaining bits, which keep their places."""
    keys = []
    for start, n in segments(max_bits):
        for bit in range(n):
            keep = ((1 << n) - 1) & ~(1 << bit)
            rest = F.shiftrightunsigned(fp, start).bitwiseAND(F.lit(keep))
            keys.append(rest.bitwiseOR(F.lit((start + bit) << 57)))
    return F.array(*keys)


def run_links(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect the members of one variant as all its pairs within
    ``max_bits`` would, at most one per member."""
    left, right = [], []
    open_ = np.arange(len(fps))
    while len(open_) > 1:
        frontier, open_ = open_[:1], open_[1:]
        while len(frontier) and len(open_):
            now, frontier = frontier[:ROWS_AT_ONCE], frontier[ROWS_AT_ONCE:]
            near = np.bitwise_count(fps[now][:, None] ^ fps[open_][None, :]) <= max_bits
            hit = near.any(axis=0)
            if hit.any():
                parents = now[near[:, hit].argmax(axis=0)]
                found = open_[hit]
                left.append(fps[parents])
                right.append(fps[found])
                frontier = np.concatenate([frontier, found])
                open_ = open_[~hit]
    return left, right


def sorted_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between rows of equal key; the rows are sorted by key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    left, right = [], []
    for s, n in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN], strict=True):
        found = run_links(fps[s : s + n], max_bits)
        left += found[0]
        right += found[1]
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    k, f = keys[short], fps[short]
    for shift in range(1, SHORT_RUN):
        same = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(same):
            break
        a, b = f[same], f[same + shift]
        near = np.bitwise_count(a ^ b) <= max_bits
        left.append(a[near])
        right.append(b[near])
    none = np.empty(0, dtype=fps.dtype)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(fps: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints (column ``fp``) that
    connect what all pairs within ``max_bits`` bits connect."""
    keyed = fps.select("fp", F.explode(variant_keys(F.col("fp"), max_bits)).alias("key"))
    total = fps.count()
    limit = max(crowded, -(-BITS * total // CROWDED_TABLE))
    part = keyed.where(F.pmod(F.xxhash64("fp"), F.lit(ESTIMATE)) == 0)
    full = (
        part.groupBy("key")
        .count()
        .where(F.col("count") * ESTIMATE > limit)
        .select("key", F.ceil(F.col("count") * ESTIMATE / limit).cast("int").alias("blocks"))
    )
    # at most BITS * total / limit <= CROWDED_TABLE rows
    dealt = keyed.join(F.broadcast(full), "key", "left").withColumn(
        "mine", F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
        lambda other: F.greatest(other, F.col("mine")) * 65536 + F.least(other, F.col("mine")),
    )
    rows = dealt.select("key", "fp", F.explode(pairs).alias("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k = np.empty(0, dtype=np.int64)
        held_p = np.empty(0, dtype=np.int32)
        held_f = np.empty(0, dtype=np.uint64)

        def out(k, p, f):
            group = np.cumsum(np.r_[0, (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
            a, b = sorted_links(group, f, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a.view(np.int64), b.view(np.int64))),
                 pa.array(np.maximum(a.view(np.int64), b.view(np.int64)))], names=["a", "b"],
            )

        for batch in batches:
            k = np.r_[held_k, batch["key"].to_numpy()]
            p = np.r_[held_p, batch["pair"].to_numpy()]
            f = np.r_[held_f, batch["fp"].to_numpy().view(np.uint64)]
            if not len(k):
                continue
            # the last group may go on in the next batch
            last = np.flatnonzero((k != k[-1]) | (p != p[-1]))
            end = last[-1] + 1 if len(last) else 0
            held_k, held_p, held_f = k[end:], p[end:], f[end:]
            if end:
                yield out(k[:end], p[:end], f[:end])
        if len(held_k):
            yield out(held_k, held_p, held_f)

    placed = rows.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return placed.select("key", "pair", "fp").mapInArrow(run, "a long, b long").distinct()


# -- classes ----------------------------------------------------------------


def star_contraction(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b)
    reaches. Alternates large-star and small-star until nothing changes."""

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = mark(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    crowded: int = CROWDED,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``. Classes and
    fingerprints with more than ``hot_rows`` rows are joined in pieces."""
    marked = materialize(fingerprints(docs, words, id_col, text_col))
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = star_contraction(links(fps.select("fp"), max_bits, crowded))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy(F.col("root").alias("class")).agg(F.min("first").alias("component_id"))
    classes = left_join_hot_left(rooted, lowest, ["root"], ["class"], ["fp", "component_id"], hot_rows)
    classes = classes.withColumnRenamed("fp", "class_fp")
    return left_join_hot_left(marked, classes, ["fp"], ["class_fp"], ["fp", "doc_id", "component_id"], hot_rows)


def fingerprint_text(fp):
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class stays, the one whose id names the class, with
    all its columns. Rows repeated with their id and text become one. Rows
    without an id cannot be named as a copy of another and stay."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    name = unused(docs, "kept_id")
    named = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(named, F.col(id_col).cast("long") == F.col(name), "left_semi")
    return kept.dropDuplicates([id_col, text_col]).unionByName(docs.where(F.col(id_col).isNull()))
