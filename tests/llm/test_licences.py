import math
import random
from collections import Counter

import pytest

from stockflow.llm import licences

PROSE = "Some words about a paper that has nothing to do with it"


def scanned(spark, texts):
    rows = [(n, f"dir{n}/file{n}", t) for n, t in enumerate([*texts, *[f"{PROSE} {i}" for i in range(20)]])]
    found = licences.scan_files(spark.createDataFrame(rows, "doc_id long, path string, text string"))
    return {r.doc_id: r for r in found.collect()}


def test_full_texts_are_licence_files(spark):
    full = licences.full_texts()
    names = sorted(full)
    # with another holder's line, and without the title line
    texts = [f"Copyright 2020 Acme Corp. All rights reserved.\n{full[n][0]}" for n in names]
    texts += [full[n][0].strip().partition("\n")[2] for n in names]
    got = scanned(spark, texts)
    for i, name in enumerate([*names, *names]):
        assert (got[i].licence, got[i].is_licence_file) == (name, True), name
    assert all(got[i].licence is None for i in range(len(texts), len(texts) + 20))


HEADERS = [
    ("Copyright 2020 Acme Corp. Licensed under the MIT License.", "MIT", "Licensed under the MIT License."),
    ("/* This work is licensed under the GNU General\n * Public License, version 2. */\nint x;", "GPL-2.0", "version 2."),
    ("# This work is licensed under the GNU General Public License,\n# version 3.\nx = 1", "GPL-3.0", "version 3."),
    (f"{PROSE}. {PROSE}. Released under the MIT License. {PROSE}.", "MIT", "Released under the MIT License."),
]


@pytest.mark.parametrize(("text", "licence", "held"), HEADERS)
def test_headers_that_share_or_cross_lines(spark, text, licence, held):
    row = scanned(spark, [text])[0]
    assert row.licence == licence
    assert [x.licence for x in row.lines] == [licence]
    assert held in text[row.lines[0].start : row.lines[0].end]
    assert row.lines[0].score > 0.9


def test_cosines_equal_a_plain_tf_idf():
    files, frequencies = 40, {"license": 7, "licensed": 9, "under": 30, "the": 40, "mit": 2, "all": 20}
    matcher = licences.Matcher(frequencies, files, licences.TEMPLATES, 0.6)
    idf = lambda t: math.log((1 + files) / (1 + frequencies.get(t, 0))) + 1
    known = licences.vocabulary(licences.TEMPLATES)

    def vector(text):
        # a word of no template counts as one that no file holds
        return {t: n * (idf(t) if t in known else math.log(1 + files) + 1) for t, n in Counter(licences.terms(text)).items()}

    def cosine(a, b):
        dot = sum(a[t] * b[t] for t in a if t in b)
        return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for text in ["Licensed under the MIT License.", "all rights of the mit license under review", "Apache License 2.0 the the"]:
        want = {n: max(cosine(vector(text), vector(t)) for t in ts) for n, ts in licences.TEMPLATES.items()}
        name, score = matcher.best(Counter(licences.terms(text)))
        assert score == pytest.approx(max(want.values())) and want[name] == pytest.approx(score)


def test_kept_matches_equal_a_comparison_of_all():
    rng = random.Random(8)
    for _ in range(300):
        found = []
        for _ in range(rng.randint(0, 40)):
            start = rng.randint(0, 60)
            found.append(("x", rng.random(), start, start + rng.randint(1, 12)))
        kept = []
        for m in found:
            if all(m[3] <= k[2] or m[2] >= k[3] for k in kept):
                kept.append(m)
        assert licences.without_overlap(found) == sorted(kept, key=lambda m: m[2])


def test_a_notice_on_very_many_lines(spark):
    n = 6000
    row = scanned(spark, ["All rights reserved.\n" * n])[0]
    assert [(x.start, x.end) for x in row.lines] == [(21 * i, 21 * i + 20) for i in range(n)]


def test_edge_rows(spark, edge_docs, no_docs):
    rows = edge_docs.selectExpr("*", "if(doc_id = 7, null, concat('d/', source)) as path")
    got = licences.licence_scan(rows).collect()
    assert sorted((r.doc_id or 0, r.licence, r.origin) for r in got) == sorted(
        (r.doc_id or 0, None, "none") for r in edge_docs.collect()
    )
    assert licences.licence_scan(no_docs.withColumnRenamed("source", "path")).count() == 0


def test_the_nearest_directory_wins_and_ties_go_to_the_smaller_name(spark):
    mit, apache = licences.full_texts()["MIT"][0], licences.full_texts()["Apache-2.0"][0]
    rows = [
        (1, "LICENSE", apache), (2, "a/b/COPYING", mit), (3, "a/x.py", "x"), (4, "a/b/c/x.py", "x"), (5, "a/b/c/x.py", "x"),
        (6, "y.py", None), (7, None, "x"), (8, "a/bb/x.py", "Licensed under the MIT License."),
    ]
    docs = spark.createDataFrame(rows + [(100 + i, f"p/f{i}", PROSE) for i in range(20)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.origin, r.origin_dir) for r in licences.licence_scan(docs).collect()}
    root = ("Apache-2.0", "inherited", "")
    assert got[1] == ("Apache-2.0", "own", "") and got[2] == ("MIT", "own", "a/b") and got[8] == ("MIT", "own", "a/bb")
    assert got[3] == got[6] == got[7] == got[100] == root and got[4] == got[5] == ("MIT", "inherited", "a/b")
