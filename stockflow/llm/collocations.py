"""Phrase collocation mining with mergeable Misra-Gries summaries.

Texts are lower-cased (A-Z only), cut into pieces at ``.,;:!?`` and line ends,
and pieces into words at spaces and tabs. Phrases of up to ``max_words`` words
inside a piece that occur at least ``threshold`` times in their language are
found in two kinds of passes:

1. *Summary passes.* Phrases travel as 64-bit hashes with the count of a
   stretch of text, hash partitioned. Every partition keeps a Misra-Gries
   summary: at most ``capacity`` counters, and when there are more, the largest
   count outside the capacity is taken from all. The capacity exceeds the
   partition's share of the phrase mass divided by the threshold, so what was
   taken in all stays below the threshold and every frequent phrase survives.
   (Were the hash partition heavier than its share and a further cut due to
   reach the threshold, the summary grows instead: the guarantee never depends
   on how even the shares are.) Summaries are sorted arrays and merge by adding
   counts; a mapper's summary is merged into the partition's as it arrives.
   Pairs of words come first; words are then only looked for in surviving pairs
   and longer phrases where all their pairs survived, told by a Bloom filter of
   at most ``filter_bits`` bits (beyond its size it lets more through, and
   nothing is lost).
2. *Exact pass.* The survivors' occurrences are counted as text, exactly. A
   task keeps its more common phrases and hands the rarer half on when its
   tally is full.

Every task hands on a row for each phrase that it has met, so small splits are
read together, in tasks of about ``TASK_TEXT`` bytes.

A phrase is cut after each of its first words, and the cut with the lowest
score floor(scale * a / (l + r)) counts, ties to the shortest first part (a, l, r: how often the
phrase, its first part and the rest occur). A phrase is dropped when a longer
candidate holds its words and occurs at least ``absorb`` per cent as often.
Products are decimals of 38 digits.

Defined cases: null text is empty; a null language is ``und``; rows repeated
count as often as they stand there; texts of any length are read in stretches
cut at piece ends, so memory follows the stretch or the longest single piece;
words longer than the hash tables reuse them from the start; ties in score and
count go to the smaller phrase in UTF-8 byte order; an empty table gives an
empty result; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.llm.common import materialize

MAX_WORDS = 4
THRESHOLD = 30
TOP = 2000
SCALE = 2_000_000
ABSORB = 80
NO_LANGUAGE = "und"
#: Bytes of text that are read at once.
STRETCH = 1 << 21
#: Bytes of text that one task reads, about; smaller splits are read together, as counts summed over more text are fewer.
TASK_TEXT = 1 << 28
#: Hashes that a mapper sums up to a run, and hashes in runs that it holds before it hands on their sums.
HELD = 1 << 21
HELD_SUMS = 1 << 23
#: Ranges of hashes, by their highest bits, in which runs are summed up.
RANGE_BITS = 7
#: Phrases that a task of the exact pass sums up before it hands the rarer half on.
HELD_PHRASES = 1 << 21
#: Phrase mass that a hash partition's summary is made for.
PARTITION_MASS = 1 << 25
#: Most bits of a Bloom filter (16 MB), bits wanted for each entry, and bits set by each.
FILTER_BITS = 1 << 27
BITS_EACH = 16
PROBES = 4

# The bytes that end a piece (. , ; : ! ? LF VT FF CR) and those that end a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACES = 4096
_RANDOM = np.random.default_rng(11).integers(0, 1 << 63, size=(2, 256 + _PLACES + 2 * MAX_WORDS), dtype=np.uint64) * 2 + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes whose low and high bits depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def stretches(texts: list[bytes], langs: list[int], size: int = STRETCH) -> Iterator[tuple[list[bytes], list[int]]]:
    """The texts in lists of about ``size`` bytes; a longer text is cut at piece ends."""
    held, held_langs, total = [], [], 0
    for text, lang in zip(texts, langs, strict=True):
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > size:
                kinds = _KIND[np.frombuffer(text, np.uint8, count=size, offset=start)]
                cuts = np.flatnonzero(kinds == 2)
                if len(cuts):
                    end = start + int(cuts[-1]) + 1
                else:  # one piece longer than a stretch: up to its end
                    rest = _KIND[np.frombuffer(text, np.uint8, offset=start + size)] == 2
                    end = start + size + int(rest.argmax()) + 1 if rest.any() else end
            held.append(text[start:end])
            held_langs.append(lang)
            total += end - start
            start = end
            if total >= size:
                yield held, held_langs
                held, held_langs, total = [], [], 0
    if held:
        yield held, held_langs


class Words:
    """The words of a list of texts: places, pieces and hashes, as arrays."""

    def __init__(self, texts: list[bytes], langs: list[int]):
        self.bytes = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = _KIND[self.bytes]
        inside = np.zeros(len(kind) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        firsts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.row = np.searchsorted(firsts, self.starts, "right") - 1
        self.lang = np.array(langs, dtype=np.int64)[self.row]

    def hashes(self, language_hash: np.ndarray, which: int = 0) -> np.ndarray:
        """A hash of every word with its language."""
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        of_byte, of_place = _RANDOM[which, :256], _RANDOM[which, 256 : 256 + _PLACES]
        lengths = self.ends - self.starts
        firsts = np.cumsum(lengths) - lengths
        inside = self.bytes[_KIND[self.bytes] == 0]
        place = np.arange(len(inside)) - np.repeat(firsts, lengths)
        values = of_byte[inside] * of_place[place & (_PLACES - 1)]
        return _mixed(np.add.reduceat(values, firsts) + language_hash[self.lang])

    def phrases(self, hashes: np.ndarray, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of the phrases of ``n`` words within a piece."""
        last = len(hashes) - n + 1
        if last <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        at = np.flatnonzero(self.piece[:last] == self.piece[n - 1 :])
        if n == 1:
            return at, hashes
        odd = _RANDOM[which, 256 + _PLACES :]
        total = np.full(len(at), odd[MAX_WORDS + n - 1], dtype=np.uint64)
        for k in range(n):
            total += hashes[at + k] * odd[k]
        return at, _mixed(total)

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(self.bytes[self.starts[k] : self.ends[k]].tobytes() for k in range(first, first + n))


def summed(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and their summed counts."""
    if counts is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    if counts is None:
        return hashes[starts], np.diff(np.r_[starts, len(hashes)])
    return hashes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def summed_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sums of runs of distinct hashes in order, one range of hashes after another."""
    edges = np.arange(1, 1 << RANGE_BITS, dtype=np.uint64) << np.uint64(64 - RANGE_BITS)
    cuts = [np.r_[0, np.searchsorted(hashes, edges), len(hashes)] for hashes, _ in runs]
    for k in range(1 << RANGE_BITS):
        parts = [(hashes[cut[k] : cut[k + 1]], counts[cut[k] : cut[k + 1]]) for (hashes, counts), cut in zip(runs, cuts, strict=True)]
        yield summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


class Summary:
    """Misra-Gries summary of hashes with a cut that stays below ``threshold``."""

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold = capacity, threshold
        self.hashes = np.empty(0, dtype=np.uint64)
        self.counts = np.empty(0, dtype=np.int64)
        self.cut = 0

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = summed(
            np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts])
        )
        if len(self.counts) <= self.capacity:
            return
        place = len(self.counts) - 1 - self.capacity
        surplus = int(np.partition(self.counts, place)[place])
        if self.cut + surplus >= self.threshold:
            return  # a heavier partition than planned: grow rather than lose a frequent phrase
        self.cut += surplus
        stays = self.counts > surplus
        self.hashes, self.counts = self.hashes[stays], self.counts[stays] - surplus

    def survivors(self) -> np.ndarray:
        """All hashes whose count may reach the threshold."""
        return self.hashes[self.counts + self.cut >= self.threshold]


class Tally:
    """Counts of phrases, told apart by two hashes; a phrase's text is read once. Should two phrases share the
    first hash, the later one is listed again and again, and the sum over equal texts puts that right."""

    def __init__(self):
        self.first = np.empty(0, dtype=np.uint64)
        self.second = np.empty(0, dtype=np.uint64)
        self.counts = np.empty(0, dtype=np.int64)
        self.place = np.empty(0, dtype=np.int64)
        #: (lang, words, phrase) of the phrases, in the order of their places.
        self.listed: list[pa.RecordBatch] = []

    def __len__(self) -> int:
        return len(self.place)

    def add(self, words: Words, names: list[str], n: int, at: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """Count the phrases of ``n`` words that start at the words ``at``."""
        order = np.lexsort((second, first))
        at, first, second = at[order], first[order], second[order]
        new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])][: len(at)])
        at, first, second, counts = at[new], first[new], second[new], np.diff(np.r_[new, len(at)])
        place = np.searchsorted(self.first, first)
        near = np.minimum(place, len(self.first) - 1)
        known = (self.first[near] == first) & (self.second[near] == second) if len(self.first) else np.zeros(len(at), dtype=bool)
        self.counts[place[known]] += counts[known]
        at, first, second, counts, place = (x[~known] for x in (at, first, second, counts, place))
        held = len(self)
        self.first = np.insert(self.first, place, first)
        self.second = np.insert(self.second, place, second)
        self.counts = np.insert(self.counts, place, counts)
        self.place = np.insert(self.place, place, held + np.arange(len(at)))
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            phrases = pa.array([words.text(i, n) for i in some.tolist()], pa.binary()).cast(pa.string())
            arrays = [pa.array([names[i] for i in words.lang[some]]), pa.array([n] * len(some), pa.int32()), phrases]
            self.listed.append(pa.RecordBatch.from_arrays(arrays, names=["lang", "words", "phrase"]))

    def out(self, rare: bool = False) -> Iterator[pa.RecordBatch]:
        """(lang, words, phrase, f) rows of all phrases, or of the ``rare`` ones alone: those that occur no
        more often than the median, half of them at least. The tally no longer holds them afterwards."""
        counts = np.empty(len(self), dtype=np.int64)
        counts[self.place] = self.counts
        stays = counts > np.median(counts) if rare and len(counts) else np.zeros(len(counts), dtype=bool)
        listed, self.listed = self.listed, []
        start = 0
        for batch in listed:
            some = slice(start, start + batch.num_rows)
            start = some.stop
            goes = batch.filter(pa.array(~stays[some]))
            if goes.num_rows:
                yield goes.append_column("f", pa.array(counts[some][~stays[some]]))
            if goes.num_rows < batch.num_rows:
                self.listed.append(batch.filter(pa.array(stays[some])))
        kept = stays[self.place]
        self.first, self.second, self.counts = self.first[kept], self.second[kept], self.counts[kept]
        self.place = (np.cumsum(stays) - 1)[self.place[kept]]


# -- Bloom filter -----------------------------------------------------------


def _bits(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield (hashes + np.uint64(k) * step) & np.uint64(size - 1)


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    found = np.ones(len(hashes), dtype=bool)
    for bit in _bits(hashes, len(words) * 64):
        found &= ((words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


def bloom_filter(survivors: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """The filter's 64-bit words. Executors set the bits and combine them; the
    driver gets the words that hold any, at most ``most_bits`` / 64."""
    wanted = max(64, survivors.count() * BITS_EACH)
    size = min(most_bits, 1 << (wanted - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            hashes = batch["h"].to_numpy().view(np.uint64)
            for bit in _bits(hashes, size):
                np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        used = np.flatnonzero(words)
        for k in range(0, len(used), 1 << 16):
            some = used[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some].view(np.int64))], names=["at", "bits"])

    rows = survivors.select("h").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = rows.toArrow()
    out = np.zeros(size // 64, dtype=np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


# -- passes -----------------------------------------------------------------


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where("text is not null and text <> ''")


def larger_tasks(texts: DataFrame, size: int) -> DataFrame:
    """``texts``, ``size`` bytes in all, in tasks of about ``TASK_TEXT`` bytes, as many as keep all cores
    busy; larger splits stay as they are."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.coalesce(max(1, -(-size // (TASK_TEXT * cores))) * cores)


def _language_hash(lang: str) -> int:
    text = np.frombuffer(lang.encode(), np.uint8)
    return int((_RANDOM[0, text] * _RANDOM[0, 256 + np.arange(len(text)) % _PLACES]).sum(dtype=np.uint64))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """(words, hash of each language, languages) of one stretch after another."""
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        names = langs.dictionary.to_pylist()
        seeds = np.array([_language_hash(name) for name in names], dtype=np.uint64)
        # a few stretches' texts at a time, not a copy of the whole batch
        rows = max(1, batch.num_rows * 4 * STRETCH // max(1, batch["text"].nbytes))
        for k in range(0, batch.num_rows, rows):
            texts = batch["text"].slice(k, rows).cast(pa.large_binary()).to_pylist()
            for some, numbers in stretches(texts, langs.indices.slice(k, rows).to_pylist()):
                yield Words(some, numbers), seeds, names


def phrase_counts(texts: DataFrame, found: Callable[[Words, np.ndarray], list[np.ndarray]]) -> DataFrame:
    """(h, c): hashes that ``found`` names for the stretches, summed up in each task until ``HELD_SUMS`` sums are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        runs: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            for hashes, counts in summed_runs(runs):
                for k in range(0, len(hashes), 1 << 16):
                    arrays = [pa.array(hashes[k : k + (1 << 16)].view(np.int64)), pa.array(counts[k : k + (1 << 16)])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["h", "c"])
            runs.clear()

        for words, seeds, _ in _read(batches):
            held += found(words, words.hashes(seeds))
            if sum(map(len, held)) >= HELD:
                runs.append(summed(np.concatenate(held)))
                held.clear()
                if sum(len(hashes) for hashes, _ in runs) >= HELD_SUMS:
                    yield from out()
        if held:
            runs.append(summed(np.concatenate(held)))
        if runs:
            yield from out()

    return texts.mapInArrow(run, "h long, c long")


def survivors(counts: DataFrame, mass: int, threshold: int) -> DataFrame:
    """(h): hashes that may occur ``threshold`` times, from a Misra-Gries summary of each hash partition."""
    shuffled = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(shuffled, -(-mass // PARTITION_MASS))
    capacity = mass // partitions // threshold + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity, threshold)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> None:
            summary.merge(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()

        for batch in batches:
            held.append((batch["h"].to_numpy().view(np.uint64), batch["c"].to_numpy()))
            if sum(len(h) for h, _ in held) >= max(capacity, 1 << 16):
                merge()
        if held:
            merge()
        left = summary.survivors().view(np.int64)
        for k in range(0, len(left), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(left[k : k + (1 << 16)])], names=["h"])

    return counts.repartition(partitions, "h").mapInArrow(run, "h long")


def exact_counts(texts: DataFrame, bits: np.ndarray, max_words: int, spark: SparkSession) -> DataFrame:
    """(lang, words, phrase, f) of every phrase that the filter lets through; words 0 is the language's word count."""
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        tally = Tally()
        totals: dict[str, int] = {}
        for words, seeds, names in _read(batches):
            for k, c in enumerate(np.bincount(words.lang, minlength=len(names)).tolist()):
                totals[names[k]] = totals.get(names[k], 0) + c
            one, two = words.hashes(seeds), words.hashes(seeds, 1)
            for n in range(1, max_words + 1):
                at, first = words.phrases(one, n)
                some = passes(table, first)
                tally.add(words, names, n, at[some], first[some], words.phrases(two, n, 1)[1][some])
            if len(tally) > HELD_PHRASES:
                yield from tally.out(rare=True)
        yield from tally.out()
        for lang, c in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([c])], names=["lang", "words", "phrase", "f"])

    counted = texts.mapInArrow(run, "lang string, words int, phrase string, f long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    filter_bits: int = FILTER_BITS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, words, phrase, f): all phrases of 2 to ``max_words`` words with
    f >= threshold and at least the words in them, f exact; and per language
    one row of 0 words whose f is the number of its words."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"max_words must be 2 to {MAX_WORDS}")
    spark = docs.sparkSession
    texts = _texts(docs, lang_col, text_col)
    # a word takes a byte and a separator, so no length has more phrases than half the bytes
    size = int(texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0)
    half = size // 2 + 1
    texts = larger_tasks(texts, size)

    def pairs(words: Words, hashes: np.ndarray) -> list[np.ndarray]:
        return [words.phrases(hashes, 2)[1]]

    found = materialize(survivors(phrase_counts(texts, pairs), half, threshold))
    shared = spark.sparkContext.broadcast(bloom_filter(found, filter_bits))

    def others(words: Words, hashes: np.ndarray) -> list[np.ndarray]:
        at, pair = words.phrases(hashes, 2)
        known = np.zeros(len(hashes) + max_words, dtype=bool)
        known[at] = passes(shared.value, pair)
        in_pair = known[: len(hashes)].copy()
        in_pair[1:] |= known[: len(hashes)][:-1]
        out = [hashes[in_pair]]
        for n in range(3, max_words + 1):
            at, phrase = words.phrases(hashes, n)
            stays = np.ones(len(at), dtype=bool)
            for k in range(n - 1):
                stays &= known[at + k]
            out.append(phrase[stays])
        return out

    found = materialize(found.unionByName(survivors(phrase_counts(texts, others), half * (max_words - 1), threshold)))
    counted = exact_counts(texts, bloom_filter(found, filter_bits), max_words, spark)
    return counted.where((F.col("f") >= threshold) | (F.col("words") == 0))


# -- scores -----------------------------------------------------------------


def scored_phrases(frequent: DataFrame, scale: int = SCALE, absorb: int = ABSORB) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one absorbs.

    Every part of a frequent phrase is frequent too, so the parts' counts come
    from the same table, by equality joins."""
    phrases = frequent.where("words >= 1")
    split = F.split("phrase", " ")
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), split.alias("w"))

    def joined(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        joined(F.lit(1), F.col("k")).alias("head"),
        joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cut = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", score)
    lowest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("words >= 3").select(
        "lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m")
    )
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("s"))
    held = (
        inner.select("lang", joined(F.col("s"), F.col("m")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longest"))
    )
    absorbed = wide("longest") * F.lit(100) >= wide("a") * F.lit(absorb)
    kept = lowest.join(held, ["lang", "phrase"], "left").where(F.col("longest").isNull() | ~absorbed)
    return kept.select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    scale: int = SCALE,
    absorb: int = ABSORB,
    filter_bits: int = FILTER_BITS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases by score, then count, then phrase; n is the language's word count."""
    frequent = materialize(frequent_phrases(docs, threshold, max_words, filter_bits, lang_col, text_col))
    # Spark keeps each task's first rows of a language before it shuffles them
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = scored_phrases(frequent, scale, absorb).withColumn("rank", F.row_number().over(order))
    ranked = scored.where(F.col("rank") <= top)
    words = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
