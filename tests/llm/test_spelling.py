"""Spelling variants: the SQL version on the small table, brute force, defined cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import EDGE_ROWS
from oracle_compare import compare, duckdb_for
from stockflow.llm import oracle, spelling
from stockflow.llm.queries import QUERIES


def edits(a, b):
    """Edit distance by the table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_groups(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if edits(w, x) == 1]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 5 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    rows = set()
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, near, form_n))
    return rows


def brute_words(rows, least=5):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                word = run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(word) >= 6:
                    counts[word] += 1
            run = ""
    return {w: n for w, n in counts.items() if n >= least}


def grouped(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("subtree_words", [spelling.SUBTREE_WORDS, 5])
def test_groups_equal_brute_force(spark, subtree_words):
    pick = random.Random(4)
    counts = {}
    for _ in range(40):
        word = "".join(pick.choice("abcdeé") for _ in range(pick.randrange(4, 10)))
        for _ in range(8):
            counts[word] = pick.choice([1, 2, 5, 25, 25, 130, 700, 4000])
            word = word or "abc"
            at = pick.randrange(len(word))
            word = pick.choice([word[:at] + word[at + 1 :], word[:at] + pick.choice("abÿ") + word[at:], word[:at] + "c" + word[at + 1 :]])
    counts["a" * 500], counts["a" * 501] = 7, 70
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(6)
    assert grouped(spelling.variant_groups(words, subtree_words=subtree_words)) == brute_groups(counts)


def test_one_edit():
    pick = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(pick.choice("ab") for _ in range(pick.randrange(5))) for _ in range(2))
        assert spelling.one_edit(a, b) == (edits(a, b) == 1), (a, b)


@pytest.mark.parametrize("leaf,few", [(spelling.LEAF, spelling.FEW_PAIRS), (1, 1)])
def test_the_search_meets_all_near_words(monkeypatch, leaf, few):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "FEW_PAIRS", few)
    words = [f"{a}{b}{c}word" for a in "abcdef" for b in "abcdéf" for c in "abcdef"] + ["x" * 9, "x" * 10]
    codes = np.array([spelling.code(w) for w in words], dtype=np.uint64)
    tree = spelling.Subtree(words, [1] * len(words), codes)
    yes = np.ones(len(words), dtype=bool)
    found = Counter((words[v], tree.words[w]) for v, w in tree.near(words, codes, yes, yes))
    assert found == Counter((a, b) for a in words for b in words if edits(a, b) == 1)


def test_query_equals_sql(spark, sf_small):
    con = duckdb_for(sf_small)
    ok, message = compare(QUERIES["op13_spelling_variants"](spark, sf_small), oracle.SPELLING, con)
    assert ok, message


def test_words_slip_by_their_hash(spark):
    rows = [(d, "Wording wördings, Wording? abcdefg ABCDEF×GHI zzzzz") for d in [*range(400), None]]
    found = {r.word: r.n for r in spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"), 6, 1).collect()}
    assert found == brute_words(rows, 1) and len(found) > 10


def test_defined_cases(spark, edge_docs, no_docs):
    assert spelling.spelling_variants(no_docs).count() == 0
    rows = [(r[0], r[1]) for r in EDGE_ROWS]
    assert grouped(spelling.spelling_variants(edge_docs, least_count=1)) == brute_groups(brute_words(rows, 1))
