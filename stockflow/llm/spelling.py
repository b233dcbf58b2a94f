"""Spelling variant grouping with a frequency-vector trie.

The words of a corpus are described by how many letters of each of ``GROUPS``
letter groups they hold (a letter's group is its code point modulo the number
of groups; counts above ``MOST`` are written as ``MOST``). The vectors form a
trie, one level per group. Two words that differ by one inserted, deleted or
replaced letter have vectors that differ by at most one surplus and one deficit
letter, so a depth-first search that may spend one of each on its way down
meets every near word; the words at the leaves are verified: by their whole
vectors, by the halves one of which must be equal, and letter by letter.

A vector is one integer, each count written as so many ones in a field of its
own, the first level highest: words in the order of these codes lie in the
order of the trie, a node is a stretch of them, and surplus and deficit are
counts of bits. The search takes all visitors of a subtree down at once.

The trie's first ``TOP_LEVELS`` levels deal the work: each node there is a
subtree of its own, held by one task, and a word visits those that its budget
reaches (only its own and later ones, so that a pair is met once). A subtree
with more than ``SUBTREE_WORDS`` words is dealt into blocks, and its visitors
visit all of them, so memory is bounded by the block whatever the vocabulary.

A word's form is its near word of largest count, if that is at least ``ratio``
times as common; the root follows forms to the last. Counts at least grow by
the ratio with every step, so the way is short, and roots come from doubling
the step a few times.

Defined cases: null text has no words; a null id is written as nothing before
the colon of the hash; rows repeated count again; words are compared by code
points (upper-case letters beyond Z stay); among equally common near words the
smaller in code-point order is the form; a word with no near word has n_near 0
and is its own root; an empty table gives an empty result; other columns are
left behind. Texts are read whole, one at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text, materialize

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
#: One run in so many loses a letter (fixed by the query's contract).
SLIP = 199
GROUPS = 12
#: The groups in the order of the trie's levels, those of common letters (t, i, e, n, a, o) first.
LEVELS = (8, 9, 5, 2, 1, 3, 6, 7, 4, 0, 10, 11)
#: Highest count of a group, and so the bits of its field.
MOST = 5
TOP_LEVELS = 4
#: Words of a subtree's block, and most subtrees that can be dealt into blocks (so that their table can be broadcast).
SUBTREE_WORDS = 20_000
SUBTREE_TABLE = 10_000
#: Words of a leaf, pairs from which on a node is divided further, and pairs compared at once.
LEAF = 64
FEW_PAIRS = 1 << 14
PAIRS_AT_ONCE = 1 << 18
#: Words that a task counts before it hands them on.
HELD_WORDS = 1 << 19


def word_runs(text: str, least: int) -> Counter:
    """How often each maximal run of at least ``least`` letters occurs, A-Z lower-cased."""
    return Counter(re.findall("[a-zÀ-ÿ]{%d,}" % least, text.encode().lower().decode()))


def slipped(word: str, prefix: int) -> str:
    """The run as read: of one in ``SLIP`` a letter is gone. ``prefix`` is the CRC of what is hashed before it."""
    h = zlib.crc32(word.encode(), prefix)
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): the words of at least ``least_letters`` letters that occur at least ``least_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            arrays = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "n"])
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in word_runs(text.as_py(), least_letters).items():
                    word = slipped(word, prefix)
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield from out()
        yield from out()

    counted = id_text(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- the trie ---------------------------------------------------------------


_FIELD = {LEVELS[level]: MOST * (GROUPS - 1 - level) for level in range(GROUPS)}


def code(word: str) -> int:
    """The word's letter-group counts, each as so many ones in its field."""
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return sum(((1 << min(c, MOST)) - 1) << _FIELD[g] for g, c in enumerate(counts) if c)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        k += 1
    if len(a) < len(b):
        return a[k:] == b[k + 1 :]
    return k < len(a) and a[k + 1 :] == b[k + 1 :]


class Halves:
    """Hashes of the words' first and last halves, for a partner as long or longer and for one a letter shorter.
    Of two words one edit apart the first or the last half of the shorter one's length stands in both."""

    def __init__(self, words: list[str]):
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        sides = [(hash(w[:h]), hash(w[len(w) - h :])) for w in words for h in (len(w) // 2, (len(w) - 1) // 2)]
        self.hashes = np.array(sides, dtype=np.int64).reshape(len(words), 2, 2)

    def may_be_near(self, mine: np.ndarray, other: Halves, theirs: np.ndarray) -> np.ndarray:
        longer = self.length[mine] - other.length[theirs]
        a = self.hashes[mine, (longer > 0).astype(np.int64)]
        b = other.hashes[theirs, (longer < 0).astype(np.int64)]
        return (np.abs(longer) <= 1) & (a == b).any(axis=1)


class Subtree:
    """Words in the order of their codes: a trie whose nodes are stretches, from level ``level`` on."""

    def __init__(self, words: list[str], counts: list[int], codes: np.ndarray, level: int = 0):
        order = np.argsort(codes, kind="stable")
        self.words = [words[k] for k in order]
        self.counts = [counts[k] for k in order]
        self.codes = codes[order]
        self.halves = Halves(self.words)
        self.level = level

    def met(self, codes: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(visitors, words) whose whole vectors differ by at most one surplus and one deficit. ``more`` and ``less``
        tell which visitors may still meet a surplus or deficit letter on their way."""
        stack = [(self.level, 0, len(self.codes), np.arange(len(codes)), more, less)]
        while stack:
            level, low, high, who, up, down = stack.pop()
            if level == GROUPS or high - low <= LEAF or (high - low) * len(who) <= FEW_PAIRS:
                step = max(1, PAIRS_AT_ONCE // (high - low))
                for k in range(0, len(who), step):
                    some = who[k : k + step]
                    mine, theirs = codes[some][:, None], self.codes[low:high][None, :]
                    near = (np.bitwise_count(theirs & ~mine) <= 1) & (np.bitwise_count(mine & ~theirs) <= 1)
                    visitor, word = np.nonzero(near)
                    yield some[visitor], word + low
                continue
            shift = np.uint64(MOST * (GROUPS - 1 - level))
            field = np.bitwise_count((self.codes[low:high] >> shift) & np.uint64((1 << MOST) - 1)).astype(np.int8)
            asked = np.bitwise_count((codes[who] >> shift) & np.uint64((1 << MOST) - 1)).astype(np.int8)
            starts = np.flatnonzero(np.r_[True, field[1:] != field[:-1]])
            for s, e in zip(starts, np.r_[starts[1:], len(field)], strict=True):
                surplus = field[s] - asked
                goes = (surplus == 0) | ((surplus == 1) & up) | ((surplus == -1) & down)
                if goes.any():
                    left = surplus[goes]
                    stack.append((level + 1, low + int(s), low + int(e), who[goes], up[goes] & (left != 1), down[goes] & (left != -1)))

    def near(self, words: list[str], codes: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple[int, int]]:
        """(visitor, word): numbers of the pairs one edit apart."""
        halves = Halves(words)
        for visitors, found in self.met(codes, more, less):
            near = halves.may_be_near(visitors, self.halves, found)
            visitors, found = visitors[near], found[near]
            for v, w in zip(visitors.tolist(), found.tolist(), strict=True):
                if one_edit(words[v], self.words[w]):
                    yield v, w


def subtrees(number: int) -> Iterator[tuple[int, bool, bool]]:
    """(subtree, may meet a surplus, may meet a deficit) that a word of the
    code ``number`` visits: its own and the later ones in the order of the trie."""
    top = number >> MOST * (GROUPS - TOP_LEVELS)

    def down(level: int, node: int, more: bool, less: bool, later: bool):
        if level == TOP_LEVELS:
            yield node, more, less
            return
        field = (top >> MOST * (TOP_LEVELS - 1 - level)) & ((1 << MOST) - 1)
        if less and later and field:
            yield from down(level + 1, node << MOST | field >> 1, more, False, later)
        yield from down(level + 1, node << MOST | field, more, less, later)
        if more and field < (1 << MOST) - 1:
            yield from down(level + 1, node << MOST | field << 1 | 1, False, less, True)

    yield from down(0, 0, True, True, False)


def placed(words: DataFrame) -> DataFrame:
    """(node, visitor, more, less, word, n, code): every word in its subtree, and as a visitor in those it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
                number = code(word)
                for k, (node, more, less) in enumerate(subtrees(number)):
                    if not k:
                        rows.append((node, False, False, False, word, n, number))
                    rows.append((node, True, more, less, word, n, number))
            types = [pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "visitor", "more", "less", "word", "n", "code"])

    schema = "node long, visitor boolean, more boolean, less boolean, word string, n long, code long"
    return words.mapInArrow(run, schema)


def near_pairs(words: DataFrame, subtree_words: int = SUBTREE_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once."""
    rows = placed(words)
    limit = max(subtree_words, -(-words.count() // SUBTREE_TABLE))
    own = rows.where(~F.col("visitor")).groupBy("node").count().where(F.col("count") > limit)
    # at most words / limit <= SUBTREE_TABLE rows
    full = F.broadcast(own.select("node", F.ceil(F.col("count") / limit).cast("int").alias("blocks")))
    last = F.coalesce("blocks", F.lit(1)) - 1
    here = F.when(F.col("visitor"), F.sequence(F.lit(0), last)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), last + 1).cast("int"))
    )
    dealt = rows.join(full, "node", "left").withColumn("block", F.explode(here)).drop("blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        members: list[pa.RecordBatch] = []
        subtree: Subtree | None = None
        numbers = lambda x: x["code"].to_numpy().view(np.uint64)
        flags = lambda x, c: x[c].to_numpy(zero_copy_only=False)
        for batch in batches:
            nodes, blocks, visitor = batch["node"].to_numpy(), batch["block"].to_numpy(), flags(batch, "visitor")
            new = (nodes[1:] != nodes[:-1]) | (blocks[1:] != blocks[:-1]) | (visitor[1:] != visitor[:-1])
            starts = np.flatnonzero(np.r_[True, new][: len(nodes)])
            out: list[tuple[str, int, str, int]] = []
            for s, e in zip(starts, np.r_[starts[1:], len(nodes)], strict=True):
                part = batch.slice(int(s), int(e - s))
                if (nodes[s], blocks[s]) != at:
                    at, members, subtree = (nodes[s], blocks[s]), [], None
                if not visitor[s]:
                    members.append(part)
                    continue
                if subtree is None:
                    held = pa.Table.from_batches(members, part.schema).combine_chunks()
                    codes = held["code"].to_numpy().view(np.uint64)
                    subtree = Subtree(held["word"].to_pylist(), held["n"].to_pylist(), codes, TOP_LEVELS)
                if not subtree.words:
                    continue
                word, n = part["word"].to_pylist(), part["n"].to_pylist()
                more, less = flags(part, "more"), flags(part, "less")
                home = (more & less).tolist()
                for v, w in subtree.near(word, numbers(part), more, less):
                    # in their own subtree two words visit each other: the smaller one names the pair
                    if not home[v] or word[v] < subtree.words[w]:
                        out.append((word[v], n[v], subtree.words[w], subtree.counts[w]))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "a_n", "b", "b_n"])

    together = dealt.repartition("node", "block").sortWithinPartitions("node", "block", "visitor")
    return together.mapInArrow(run, "a string, a_n long, b string, b_n long")


# -- forms and roots --------------------------------------------------------


def variant_groups(words: DataFrame, ratio: int = RATIO, subtree_words: int = SUBTREE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n)."""
    words = materialize(words)
    pairs = near_pairs(words, subtree_words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    near = pairs.select(F.explode(sides).alias("s")).select("s.*")
    # the most common near word, the smaller of equally common ones
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    )
    first = (-F.col("best.col1")).alias("form_n")
    joined = words.join(best.select("word", "n_near", F.col("best.near").alias("near"), first), "word", "left")
    common = F.col("form_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(
        joined.select(
            "word",
            F.when(common, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(common, F.col("form_n")).alias("form_n"),
        )
    )
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: where following forms ends."""
    ways = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(
            ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        )
        ways = longer.select("word", "root")
        if longer.where("next is not null").isEmpty():
            return ways


def spelling_variants(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    subtree_words: int = SUBTREE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the corpus's words."""
    return variant_groups(vocabulary(docs, least_letters, least_count, id_col, text_col), ratio, subtree_words)
