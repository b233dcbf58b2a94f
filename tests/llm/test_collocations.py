"""Phrase mining against brute force, and the summaries' guarantee."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from stockflow.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string"
PIECES = re.compile(r"[.,;:!?\n\x0b\x0c\r]")
WORDS = re.compile(r"[^ \t]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, top, max_words=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in PIECES.split((text or "").translate(LOWER)):
            words = WORDS.findall(piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {p: c for p, c in f.items() if c >= threshold}
    out = []
    for p, a in frequent.items():
        lang, words = p[0], p[1:]
        if len(words) < 2:
            continue
        longer = [c for q, c in frequent.items() if q[0] == lang and len(q) > len(p)
                  and any(q[i : i + len(words)] == words for i in range(1, len(q) - len(words) + 1))]
        if any(100 * c >= 80 * a for c in longer):
            continue
        cuts = [(2_000_000 * a // (f[(lang, *words[:k])] + f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, last = [], Counter()
    for lang, phrase, a, left, right, total, score in out:
        last[lang] += 1
        if last[lang] <= top:
            ranked.append((lang, last[lang], phrase, a, left, right, total, score))
    return ranked


def corpus(n, seed=3):
    pick = random.Random(seed)
    words = ["la", "Le", "è", "öl", "new", "york", "city", "state", "of", "the", "x" * 40]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", "! "]
    rows = []
    for k in range(n):
        text = "".join(pick.choice(words) + pick.choice(marks) for _ in range(pick.randrange(60)))
        rows.append((k, text + " New York City state of", pick.choice(["en", "fr", None])))
    return rows + [(None, None, "en"), (1, "", None), (2, " \t.\n", "xx"), (3, "only one", "yy")]


def rows_of(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("threshold,top,bits", [(5, 2000, 1 << 20), (20, 7, 1 << 20), (5, 2000, 64)])
def test_equals_brute_force(spark, monkeypatch, threshold, top, bits):
    rows = corpus(300)
    monkeypatch.setattr(col, "STRETCH", 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = col.collocations(df, threshold=threshold, top=top, filter_bits=bits)  # 64 bits: a filter that holds nothing back
    assert rows_of(found) == brute(rows, threshold, top)


def test_defined_cases(spark, edge_docs, no_docs):
    assert col.collocations(no_docs).count() == 0
    from conftest import EDGE_ROWS

    rows = [(r[0], r[1], r[2]) for r in EDGE_ROWS]
    assert rows_of(col.collocations(edge_docs, threshold=30)) == brute(rows, 30, 2000)


def test_a_stretch_never_cuts_a_piece():
    texts = [b"a b.c d e\nf", b"", b"one very long piece without an end", b"x, y"]
    words = []
    for size in (1, 3, 1000):
        found = []
        for some, langs in col.stretches(texts, [0, 1, 2, 3], size):
            w = col.Words(some, langs)
            found += [(int(w.lang[i]), w.text(i, 2)) for i in w.phrases(w.hashes(np.arange(4, dtype=np.uint64)), 2)[0]]
        words.append(found)
    assert words[0] == words[1] == words[2]
    assert (0, b"b c") not in words[0] and (2, b"one very") in words[0]


def test_summary_keeps_every_frequent_hash_and_stays_within_capacity():
    pick = np.random.default_rng(1)
    rare = pick.integers(1 << 40, 1 << 62, 200_000).astype(np.uint64)
    often = np.repeat(np.arange(500, dtype=np.uint64), 30)
    hashes = np.concatenate([rare, often])
    pick.shuffle(hashes)
    capacity = len(hashes) // 30 + 1
    whole = col.Summary(capacity, 30)
    halves = [col.Summary(capacity, 30), col.Summary(capacity, 30)]
    for k, part in enumerate(np.array_split(hashes, 40)):
        whole.merge(*col.summed(part))
        halves[k % 2].merge(*col.summed(part))
        assert len(whole.hashes) <= capacity
    assert 0 < whole.cut < 30
    assert set(range(500)) <= set(whole.survivors().tolist())
    # summaries merge: what two cut in all still stays below the threshold
    halves[0].merge(halves[1].hashes, halves[1].counts)
    assert halves[0].cut + halves[1].cut < 30


def test_a_heavier_partition_grows_instead_of_losing():
    hashes = np.repeat(np.arange(100, dtype=np.uint64), 30)
    summary = col.Summary(10, 30)
    for part in np.array_split(hashes, 7):
        summary.merge(*col.summed(part))
    assert set(summary.survivors().tolist()) == set(range(100))


def test_small_splits_are_read_together(spark, monkeypatch):
    rows = corpus(300)
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame(rows, SCHEMA).repartition(4 * cores)
    read = []

    def noted(made):
        return lambda texts, *rest: (read.append(texts.rdd.getNumPartitions()), made(texts, *rest))[1]

    for name in ("phrase_counts", "exact_counts"):
        monkeypatch.setattr(col, name, noted(getattr(col, name)))
    assert rows_of(col.collocations(df, threshold=5)) == brute(rows, 5, 2000)
    assert read == [cores] * 3  # one row per task and phrase: four times as many tasks would hand on four times as many
    size = sum(len((text or "").encode()) + 1 for _, text, _ in rows if text)
    for tasks in (2, 4, 9):  # more text means more tasks, and no split is cut
        monkeypatch.setattr(col, "TASK_TEXT", size // (tasks * cores) + 1)
        read.clear()
        assert rows_of(col.collocations(df, threshold=5)) == brute(rows, 5, 2000)
        assert read == [min(tasks, 4) * cores] * 3


def test_a_task_hands_on_each_hash_once(spark, monkeypatch):
    monkeypatch.setattr(col, "HELD", 64)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 20)
    try:
        texts = col._texts(spark.createDataFrame(corpus(300), SCHEMA).coalesce(1), "lang", "text")
        pairs = lambda words, hashes: [words.phrases(hashes, 2)[1]]
        handed = [tuple(r) for r in col.phrase_counts(texts, pairs).collect()]
        assert len(handed) == len({h for h, _ in handed})
        monkeypatch.setattr(col, "HELD_SUMS", 300)
        often = [tuple(r) for r in col.phrase_counts(texts, pairs).collect()]
    finally:
        spark.conf.set(batch, before)
    assert len(often) > len(handed)
    total = Counter()
    for h, c in often:
        total[h] += c
    assert total == dict(handed)


def test_sums_of_runs_equal_the_sums_of_all():
    pick = np.random.default_rng(5)
    parts = [pick.integers(0, 1 << 63, 3000, dtype=np.uint64)[pick.integers(0, 3000, n)] * np.uint64(2) for n in (0, 1, 5000, 9000)]
    parts += [parts[2], np.array([0, (1 << 64) - 1], dtype=np.uint64)]
    hashes, counts = (np.concatenate(x) for x in zip(*col.summed_runs([col.summed(p) for p in parts]), strict=True))
    whole = col.summed(np.concatenate(parts))
    assert (hashes == whole[0]).all() and (counts == whole[1]).all() and len(hashes) == len(whole[0])


def test_a_full_tally_hands_on_rare_phrases_and_keeps_the_others():
    seeds = np.arange(1, 3, dtype=np.uint64)
    tally, handed, expected = col.Tally(), [], Counter()
    for k in range(20):
        rare = " ".join(f"rare{k}x{j}" for j in range(60))
        words = col.Words([f"new york. {rare}, new york".encode(), b"new york"], [0, 1])
        for n in (1, 2):
            at, first = words.phrases(words.hashes(seeds), n)
            tally.add(words, ["en", "fr"], n, at, first, words.phrases(words.hashes(seeds, 1), n, 1)[1])
            expected.update((("en", "fr")[words.lang[i]], n, words.text(i, n).decode()) for i in at)
        if len(tally) > 300:
            before = len(tally)
            for batch in tally.out(rare=True):
                handed += batch.to_pylist()
            assert len(tally) <= before // 2
    assert handed
    for batch in tally.out():
        handed += batch.to_pylist()
    assert len(tally) == 0 and not list(tally.out())
    total = Counter()
    for row in handed:
        total[row["lang"], row["words"], row["phrase"]] += row["f"]
    assert total == expected
    # frequent phrases are handed on once, not every time the tally is full
    assert sorted((r["lang"], r["f"]) for r in handed if r["phrase"] == "new york") == [("en", 40), ("fr", 20)]
