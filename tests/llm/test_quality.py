"""Line-first cleaning: the SQL version on the small table, rules line by line, defined cases."""

import random
import re
from collections import Counter

import pytest

from conftest import EDGE_ROWS
from oracle_compare import compare, duckdb_for
from stockflow.llm import oracle, quality
from stockflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeats = sum(line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside))


@pytest.mark.parametrize("long_text", [quality.LONG_TEXT, 3])
def test_base_counts_equal_brute_force(monkeypatch, long_text):
    monkeypatch.setattr(quality, "LONG_TEXT", long_text)
    pick = random.Random(2)
    parts = ["a", "b", "é", "😀#", "c|", " ", "\n", "\t", " ", "\x0b", " ", " a b c "]
    for _ in range(300):
        text = "".join(pick.choice(parts) + pick.choice(["", " "]) for _ in range(pick.randrange(40)))
        assert tuple(quality.base_counts(text)) == brute_base(text), repr(text)


@pytest.mark.parametrize(
    "line,rule",
    [
        ("This is a plain sentence.", None),
        ("a long line that does not end with a mark stays all the same", None),
        ('He said "enough."', None),
        ("No mark here", "punctuation"),
        ("Buy$$$ now### it*** is%%% cheap.", "punctuation"),
        ("SALE!! SALE!! ONLY!! TODAY!! HERE!!", "punctuation"),
        ("products | prices | team | jobs | press.", "navigation"),
        ("Home News Blog Contact Help.", "navigation"),
        ("Copyright 2020, all rights reserved.", "boilerplate"),
        ("By the privacy policy " + "of this large company " * 8 + "nothing changes.", None),
        ("tre tre la la que que so so.", "boilerplate"),
    ],
)
def test_rules(line, rule):
    found = quality.failed_rule(line)
    assert (None if found is None else quality.RULES[found]) == rule


def test_query_equals_sql(spark, sf_small):
    con = duckdb_for(sf_small)
    ok, message = compare(QUERIES["op12_quality_rules"](spark, sf_small), oracle.QUALITY, con)
    assert ok, message


def test_cleaned_text_and_verdict(spark):
    line = lambda k: " ".join(f"word{k}{c}" for c in "abcdefghi") + "."
    menu = "one | two | three | four | five | six | seven | eight"
    rows = [
        (1, "\n".join([*map(line, range(7)), "", menu])),
        (2, "\n".join([*map(line, range(4)), *(menu.replace("e", f"{k}") for k in range(4))])),
    ]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].kept and found[1].cleaned == rows[0][1].removesuffix(menu).removesuffix("\n")
    assert found[1].lost_navigation == len("onetwothreefourfivesixseveneight") + 7
    assert not found[2].kept and not found[2].base_failed
    stays = quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in stays] == [1]


def test_defined_cases(spark, edge_docs, no_docs):
    assert quality.judge(no_docs).count() == 0
    found = quality.judge(edge_docs).collect()
    want = sorted((r[0] is not None, r[0] or 0, *brute_base(r[1] or "")) for r in EDGE_ROWS)
    names = quality.Base._fields
    assert sorted((r.doc_id is not None, r.doc_id or 0, *(r[c] for c in names)) for r in found) == want
