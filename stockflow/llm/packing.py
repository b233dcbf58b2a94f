"""Best-fit packing by bin completion.

Documents become token sequences of at most ``capacity`` tokens. Only the
lengths 1..capacity matter for the packing, so the corpus is reduced to a
histogram of piece lengths (at most ``capacity`` rows, whatever the input),
and the search runs on that: *how often* each filling is used, not which
document goes where. Spark then numbers the pieces of each length and places
them by number.

The search (``pack_histogram``) is bin completion: take the largest remaining
length, enumerate the fillings of the room beside it, of any number of members,
least waste first, and branch over them and over how often each is used (most
often first). A filling is left out when one available length in the place of
one or two of its members, or in its free room, gives a filling at least as
full. Further fillings are made only when the search comes back for them. A
branch is cut when its bins so far plus a waste-aware lower bound on the rest
reach the best known packing. Best-fit decreasing gives the first best packing,
and the first dive of the search, which always runs to its end, another; the
search ends when a packing meets the lower bound of the whole histogram, when
no branch is left (the packing is optimal then), or after ``max_steps`` steps.
Every packing it holds is complete, so the step limit bounds optimality, never
the result.

Defined cases: null text is empty text and has the closing id only; repeated
rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text, materialize
from stockflow.llm.tokens import encoder
from stockflow.operators.ranking import sequence_number

CAPACITY = 1024
END_ID = 2
#: Steps after which the search returns the best packing it has.
MAX_STEPS = 400_000
#: Steps for putting the fullest fillings of few members first; all others follow.
FEW_FIRST = 2_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

# A packing: (runs, times) pairs, a run being (length, copies).
Filling = tuple[tuple[int, int], ...]
Packing = list[tuple[Filling, int]]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but maybe the first."""
    first = n % capacity or capacity
    return [(0, min(n, first))] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece; with ``keep_ids`` also the ids themselves (binary,
    little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_path).ids
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = ids_of(text.as_py()) + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * s : 4 * (s + n)]
                    rows.append((doc_id, k, s, n, zlib.crc32(part), *([part] if keep_ids else [])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if keep_ids else [])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "")
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


# -- the search, on the histogram ------------------------------------------


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: for each k, lengths over capacity - k sit
    alone, lengths over half need a bin each, and what the others exceed the
    room beside those needs further bins."""
    total = sum(s * c for s, c in counts.items())
    best = -(-total // capacity)
    half = capacity // 2
    big = sum(c for s, c in counts.items() if s > half)
    best = max(best, big)
    large = sorted((s for s in counts if counts[s] and s > half), reverse=True)
    mid_sum = paired = paired_sum = 0
    for k in sorted((s for s in counts if counts[s] and s <= half), reverse=True):
        mid_sum += k * counts[k]
        while large and large[-1] <= capacity - k:
            s = large.pop()
            paired += counts[s]
            paired_sum += s * counts[s]
        room = paired * capacity - paired_sum
        best = max(best, big + max(0, -(-(mid_sum - room) // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing; bins of equal content and room are one group. A
    bin that takes a length is again the fullest that can take it, so each
    bin takes all the copies it has room for before the next one does."""
    by_room: dict[int, Packing] = {}
    for s in sorted((s for s in counts if counts[s]), reverse=True):
        left = counts[s]
        for room in range(s, capacity + 1):
            groups = by_room.pop(room, [])
            while left and (groups or room == capacity):
                filling, bins = groups.pop() if groups else ((), left)
                k = room // s
                full = min(bins, left // k)
                if full:
                    by_room.setdefault(room - k * s, []).append(((*filling, (s, k)), full))
                    left -= full * k
                    bins -= full
                if bins and left:
                    by_room.setdefault(room - left * s, []).append(((*filling, (s, left)), 1))
                    left = 0
                    bins -= 1
                if bins and filling:
                    groups.append((filling, bins))
            if groups:
                by_room.setdefault(room, []).extend(groups)
            if not left:
                break
    return [g for groups in by_room.values() for g in groups]


class Work:
    """Counts the search's steps against its limit."""

    def __init__(self, limit: int):
        self.left = limit


def dominated(members: tuple[int, ...], counts, waste: int) -> bool:
    """Whether one more available length fits in, or one in the place of one or
    two of the members gives a filling at least as full."""
    used = Counter(members)
    distinct = list(used)
    sums = {x + y for i, x in enumerate(distinct) for y in distinct[i + (used[x] < 2) :]}
    places = [(x + 1, x + waste) for x in (0, *distinct)] + [(x, x + waste) for x in sums]
    return any(counts[y] > used[y] for a, b in places for y in range(a, min(b + 1, len(counts))))


def _few_members(counts, lengths: list[int], target: int, work: Work) -> Iterator[tuple[int, ...]]:
    """Fillings of ``target`` in order of their number of members, as many as
    FEW_FIRST steps find. ``sums[k]`` has a bit for each sum of k lengths."""
    steps = FEW_FIRST
    mask = (2 << target) - 1
    sums = [1]
    for members in range(1, target // lengths[0] + 1):
        level = 0
        for x in lengths:
            level |= sums[-1] << x
        sums.append(level & mask)
        steps -= len(lengths) // 16 + 1
        if steps <= 0 or work.left <= 0:
            return
        if not sums[-1] >> target & 1:
            continue
        stack: list[tuple[tuple[int, ...], int, int]] = [((), target, len(lengths) - 1)]
        while stack:
            chosen, rest, i = stack.pop()
            left = members - len(chosen)
            if not left:
                yield chosen
                continue
            steps -= 1
            work.left -= 1
            if steps <= 0 or work.left <= 0:
                return
            i = min(i, bisect_right(lengths, rest) - 1)
            while i >= 0 and lengths[i] * left >= rest:
                x = lengths[i]
                if sums[left - 1] >> (rest - x) & 1 and counts[x] > chosen.count(x):
                    stack.append((chosen, rest, i - 1))
                    stack.append(((*chosen, x), rest - x, i))
                    break
                i -= 1


def _reach(counts, lengths: list[int], room: int) -> Iterator[int]:
    """For the first 0, 1, 2, ... lengths, the bits of the sums up to ``room``
    that as many of them as there are can make."""
    mask = (2 << room) - 1
    reach = 1
    yield reach
    for x in lengths:
        left, part = min(counts[x], room // x), 1
        while left:
            part = min(part, left)
            reach |= reach << x * part & mask
            left -= part
            part *= 2
        yield reach


def fillings(counts, room: int, work: Work) -> Iterator[tuple[int, ...]]:
    """The undominated ways to fill ``room``, least waste first, made one by one
    as they are asked for. Of the fullest ones, those of few members come first.
    When the steps are used up, the next filling is made all the same."""
    lengths = [x for x in range(1, room + 1) if counts[x]]
    if not lengths:
        yield ()
        return
    for full in _reach(counts, lengths, room):
        pass
    work.left -= len(lengths) // 8
    target = full.bit_length() - 1
    given = set()
    for members in _few_members(counts, lengths, target, work):
        if not dominated(members, counts, room - target):
            given.add(members)
            yield members
    reach = list(_reach(counts, lengths, room))
    for total in range(target, -1, -1):
        if not full >> total & 1:
            continue
        stack: list[tuple[tuple[int, ...], int, int]] = [((), total, len(lengths) - 1)]
        while stack:
            chosen, rest, i = stack.pop()
            work.left -= 1
            if not rest:
                if chosen not in given and (work.left <= 0 or not dominated(chosen, counts, room - total)):
                    yield chosen
                continue
            i = min(i, bisect_right(lengths, rest) - 1)
            x = lengths[i]
            for k in range(min(counts[x], rest // x) + 1):  # the most is taken up first
                if reach[i] >> (rest - k * x) & 1:
                    stack.append((chosen + (x,) * k, rest - k * x, i - 1))


def _children(left: array, bins: int, steps: tuple | None, capacity: int, work: Work) -> Iterator[tuple]:
    """(counts, bins, steps so far as a linked list) behind each way to go on."""
    s = max(x for x, c in enumerate(left) if c)
    beside = left[:]
    beside[s] -= 1
    for rest in fillings(beside, capacity - s, work):
        runs = Counter((s, *rest))
        filling = tuple(sorted(runs.items(), reverse=True))
        for times in range(min(left[x] // k for x, k in filling), 0, -1):
            new = left[:]
            for x, k in filling:
                new[x] -= k * times
            yield new, bins + times, ((filling, times), steps)


def search(counts: dict[int, int], capacity: int, max_steps: int) -> tuple[Packing, int, int]:
    """(packing, lower bound, steps left): no steps left means that the search
    was ended by its limit."""
    counts = {s: c for s, c in counts.items() if c}
    best = best_fit_decreasing(counts, capacity)
    best_bins = sum(n for _, n in best)
    bound = lower_bound(counts, capacity)
    work = Work(max_steps)
    start = array("q", [0]) * (capacity + 1)
    for s, c in counts.items():
        start[s] = c
    stack = [_children(start, 0, None, capacity, work)] if counts else []
    dived = False  # the first dive has come to its end
    while stack and best_bins > bound and (work.left > 0 or not dived):
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            continue
        left, bins, steps = child
        work.left -= capacity // 8  # a node's own bookkeeping
        alive = {s: c for s, c in enumerate(left) if c}
        if bins + lower_bound(alive, capacity) >= best_bins:
            dived = True
        elif alive:
            stack.append(_children(left, bins, steps, capacity, work))
        else:
            dived, best_bins, best = True, bins, []
            while steps:
                best.append(steps[0])
                steps = steps[1]
    return best, bound, max(work.left, 0)


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY, max_steps: int = MAX_STEPS) -> Packing:
    """As few bins as the search finds for ``counts`` (length -> how many)."""
    return search(counts, capacity, max_steps)[0]


# -- placing the pieces -----------------------------------------------------


def placement_runs(packing: Packing, first_sequence: int = 0) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, copies, sequence, offset): pieces of that length
    numbered from..to-1 go, ``copies`` to a bin, into the bins from
    ``sequence`` on, starting at ``offset``."""
    taken: Counter = Counter()
    rows = []
    sequence = first_sequence
    for filling, times in packing:
        offset = 0
        for s, k in filling:
            rows.append((s, taken[s], taken[s] + k * times, k, sequence, offset))
            taken[s] += k * times
            offset += s * k
        sequence += times
    return rows


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, max_steps: int = MAX_STEPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset``. The histogram has at most
    ``capacity`` rows; the placement table has a row for each run of each
    filling, bounded by the search and not by the input."""
    spark = pieces.sparkSession
    numbered = sequence_number(pieces, ["doc_id", "piece"], segment=["length"], name="_n")
    numbered = materialize(numbered.withColumn("_n", F.col("_n").cast("long") - 1))
    counts = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = placement_runs(pack_histogram(counts, capacity, max_steps))
    table = spark.createDataFrame(
        runs, "_len long, _from long, _to long, _copies long, _seq long, _off long"
    )
    here = (F.col("length") == F.col("_len")) & (F.col("_n") >= F.col("_from")) & (F.col("_n") < F.col("_to"))
    k = F.col("_n") - F.col("_from")
    return numbered.join(F.broadcast(table), here).select(
        *[c for c in pieces.columns],
        (F.col("_seq") + F.floor(k / F.col("_copies"))).cast("long").alias("sequence_id"),
        (F.col("_off") + F.pmod(k, F.col("_copies")) * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_pack(docs: DataFrame, tokenizer_path: str, **names) -> DataFrame:
    """Token pieces of the documents with their sequence and offset."""
    return pack_pieces(materialize(token_pieces(docs, tokenizer_path, **names)))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces that kept their ids: the
    pieces of a sequence are at most ``capacity`` tokens in all."""
    return packed.groupBy("sequence_id").agg(
        F.expr("array_sort(collect_list(struct(offset, doc_id, piece, ids)))").alias("p")
    ).select(
        "sequence_id", F.expr("p.doc_id").alias("doc_ids"), F.expr("array_join(transform(p, x -> hex(x.ids)), '')").alias("_h")
    ).select("sequence_id", "doc_ids", F.unhex("_h").alias("ids"))
