"""Document fingerprints by spot signatures.

Common words are anchors. Each occurrence of an anchor starts a chain of the
next ``chain`` content words (words that are no anchors); the hash of anchor
and chain is a signature, and a text's fingerprint is the set of its
signatures, written as the base64 of the sorted 32-bit hashes. Two
fingerprints are compared by the Jaccard likeness of their sets.

Anchors are the corpus's own most frequent short words by document frequency,
counted over all documents for each language with ``LEAST_DOCUMENTS`` or more
of them, so a rare language brings its own; a language's words are anchors in
every text. Lists, headings and languages with fewer documents may hold few
common words; therefore words whose hash is divisible by ``RARE_ANCHORS`` are
anchors as well, in every text.

Finding all similar pairs (``similar_classes``) uses that sets whose sizes
differ too much cannot be similar: sets are partitioned by length so that a
set can only be similar to one of its own or the next partition, candidates
share one of their rarest signatures (as many as the threshold requires), and
a comparison stops as soon as the sizes rule the threshold out.

Defined cases: null text is empty text; a text without any complete chain has
one signature of all its words, or of the text itself if it has none, so equal
texts always have equal fingerprints and two different texts never meet by
having none; repeated rows are separate neighbours of each other; rows without
an id come last; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import id_text, materialize

ANCHORS = 48
RARE_ANCHORS = 16
#: Documents that a language needs before its common words can be told.
LEAST_DOCUMENTS = 30
#: Letters of an anchor at most.
ANCHOR_LETTERS = 6
CHAIN = 2
SIMILAR = 0.8
LAST = 2**63 - 1
#: Words whose hashes a worker remembers before it starts anew.
REMEMBERED = 500_000
_WORD = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def common_words(
    docs: DataFrame,
    n: int = ANCHORS,
    letters: int = ANCHOR_LETTERS,
    text_col: str = "text",
    lang_col: str | None = "lang",
    least_documents: int = LEAST_DOCUMENTS,
) -> list[str]:
    """The ``n`` words of at most ``letters`` letters that most documents of a
    language hold, for all languages with ``least_documents`` documents; ties go
    to the smaller word. Counted over all documents; the driver gets ``n`` short
    words a language. A null language is one of its own."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")
    word = F.lit(rf"(?<!\p{{L}})\p{{L}}{{1,{letters}}}(?!\p{{L}})")
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), word, F.lit(0)))
    large = docs.groupBy(lang.alias("lang")).count().where(F.col("count") >= least_documents).select("lang")
    counts = docs.select(lang.alias("lang"), F.explode(words).alias("word")).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= n).join(large, "lang", "left_semi")
    return sorted({r["word"] for r in best.select("word").distinct().collect()})


class Signer:
    """Signature sets of texts for a list of anchors."""

    def __init__(self, anchors: list[str], chain: int = CHAIN):
        self.chain = chain
        self.anchors = np.array(sorted(xxhash.xxh64_intdigest(a) for a in anchors), dtype=np.uint64)
        self.known: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return np.array([known[w] for w in words], dtype=np.uint64)

    def signatures(self, text: str) -> np.ndarray:
        """Sorted distinct 32-bit signatures."""
        h = self.hashes(_WORD.findall(text.lower()))
        is_anchor = np.isin(h, self.anchors) | (h % np.uint64(RARE_ANCHORS) == 0)
        at = np.flatnonzero(is_anchor)
        content = np.flatnonzero(~is_anchor)
        first = np.searchsorted(content, at)
        whole = first + self.chain <= len(content)
        at, first = at[whole], first[whole]
        if not len(at):
            # a lone signature keeps the fingerprint a function of the text
            raw = h.tobytes() if len(h) else text.encode("utf-8", "surrogatepass")
            return np.array([xxhash.xxh32_intdigest(raw, len(h))], dtype=np.uint32)
        mixed = h[at]
        for k in range(self.chain):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + h[content[first + k]]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        return np.unique((mixed >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 without looking at them if their
    sizes rule out ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprint_text(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as much of the following text's start."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


# -- each document beside the next -----------------------------------------


def _bucket(order: Column, starts: list[int]) -> Column:
    """How many of the sorted ``starts`` are at or before ``order``, looked up
    among every ``step``-th first and then between two of those."""
    step = max(1, int(len(starts) ** 0.5))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]).cast("array<bigint>")
    coarse = F.size(F.filter(longs(starts[step - 1 :: step]), lambda s: s <= order))
    fine = F.array(*[longs(starts[k : k + step - 1]) for k in range(0, len(starts) + 1, step)])
    return coarse * step + F.size(F.filter(F.element_at(fine, coarse + 1), lambda s: s <= order))


def beside_next(docs: DataFrame, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(bucket, borrowed, ord, doc_id, text): documents in buckets of
    consecutive ids, sorted in each; after a bucket's own rows comes a borrowed
    copy of the next bucket's first document (after the last: of the first).
    The texts are shuffled once."""
    rows = id_text(docs, id_col, text_col).withColumn("ord", F.coalesce("doc_id", F.lit(LAST)))
    cuts = [k / buckets for k in range(1, buckets)]
    got = rows.agg(F.min("ord").alias("low"), F.percentile_approx("ord", cuts or [0.5], 10_000).alias("cuts")).first()
    starts = sorted({c for c in got["cuts"] or [] if c > got["low"]}) if cuts else []
    bucket = _bucket(F.col("ord"), starts)
    last = len(starts)
    # the first ids of the buckets are ids of the table, so each has its rows
    begins = F.array(*[F.lit(x).cast("long") for x in [got["low"] or 0, *starts]])
    places = F.when(
        F.col("ord") == F.element_at(begins, F.col("b") + 1),
        F.array(
            F.struct(F.col("b").alias("bucket"), F.lit(0).alias("borrowed")),
            F.struct(F.when(F.col("b") == 0, last).otherwise(F.col("b") - 1).alias("bucket"), F.lit(1).alias("borrowed")),
        ),
    ).otherwise(F.array(F.struct(F.col("b").alias("bucket"), F.lit(0).alias("borrowed"))))
    placed = rows.withColumn("b", bucket).select(F.explode(places).alias("p"), "ord", "doc_id", "text")
    return (
        placed.select("p.bucket", "p.borrowed", "ord", "doc_id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "borrowed", "ord", F.xxhash64("text"))
    )


FINGERPRINT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_edits(
    docs: DataFrame, anchors: list[str], chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of each document and of its edited text (see
    ``edited_text``; the following document is the next by id), with the
    likeness of the document to its edit and to the following one."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [c.split()[0] for c in FINGERPRINT_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(anchors, chain)
        held = None  # (bucket, id, text, signatures) waiting for what follows
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("bucket", "borrowed", "doc_id"))
            for bucket, borrowed, doc_id, cell in zip(*columns, batch["text"], strict=True):
                if held is None and borrowed:
                    continue  # a further copy of the borrowed id
                text = cell.as_py()
                own = signer.signatures(text)
                if held is not None:
                    _, held_id, held_text, sigs = held
                    edit = edited_text(held_text, text)
                    edit_sigs = signer.signatures(edit)
                    digest = hashlib.sha256(edit.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append(
                        (held_id, len(held_text), digest, fingerprint_text(sigs), fingerprint_text(edit_sigs),
                         likeness(sigs, edit_sigs), likeness(sigs, own))
                    )
                held = None if borrowed else (bucket, doc_id, text, own)
            arrays = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, kinds, strict=True)], names=names)

    beside = beside_next(docs, buckets, id_col, text_col)
    return beside.select("bucket", "borrowed", "doc_id", "text").mapInArrow(run, FINGERPRINT_SCHEMA)


# -- all similar documents --------------------------------------------------


def signature_sets(docs: DataFrame, anchors: list[str], chain: int = CHAIN, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, sigs): each document's set as a sorted array of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(anchors, chain)
        for batch in batches:
            sets = [signer.signatures(t.as_py()).astype(np.int64) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "sigs"]
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, sigs array<bigint>")


def length_partition(size: Column, least: float) -> Column:
    """Partition k holds sizes from least**-k on: a set similar to one in
    partition k lies in k - 1, k or k + 1."""
    return F.floor(F.log(size) / F.lit(-np.log(least)) + 1e-9).cast("int")


def similar_links(sets: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(a, b, likeness), a < b, between different sets of ``sets`` (set_id,
    sigs): candidates share one of their rarest signatures in one or
    neighbouring length partitions, and each is verified."""
    sized = sets.select("set_id", "sigs", F.size("sigs").alias("n"))
    counts = sized.select(F.explode("sigs").alias("sig")).groupBy("sig").count()
    keyed = sized.select("set_id", "n", F.explode("sigs").alias("sig")).join(counts, "sig")
    need = (F.col("n") - F.ceil(F.col("n") * least) + 1).cast("int")
    prefixes = (
        keyed.groupBy("set_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("count", "sig"))).alias("s"))
        .select("set_id", "n", length_partition(F.col("n"), least).alias("part"), F.explode(F.slice("s", F.lit(1), need)).alias("s"))
        .select("set_id", "n", "part", "s.sig")
    )
    left = prefixes.select(F.col("set_id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = prefixes.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), "sig", "part")
    pairs = left.join(right, ["part", "sig"]).where(
        (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    ).where(F.col("na") >= least * F.col("nb")).select("a", "b").distinct()
    one = sets.select(F.col("set_id").alias("a"), F.col("sigs").alias("sa"))
    two = sets.select(F.col("set_id").alias("b"), F.col("sigs").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        (shared / (F.size("sa") + F.size("sb") - shared)).alias("likeness"),
    ).where(F.col("likeness") >= least)


def similar_documents(docs: DataFrame, anchors: list[str], least: float = SIMILAR, **names) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has (doc_id, set_id) for every document, the
    id of its signature set; links has the similar pairs of different sets.
    Copies share a set and are not expanded into pairs."""
    marked = materialize(
        signature_sets(docs, anchors, **names).withColumn("set_id", F.xxhash64("sigs"))
    )
    sets = marked.groupBy("set_id").agg(F.any_value("sigs").alias("sigs"))
    return marked.select("doc_id", "set_id"), similar_links(materialize(sets), least)
