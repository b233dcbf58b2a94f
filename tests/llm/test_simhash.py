"""Against brute force over all pairs of fingerprints."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stockflow.llm import simhash
from stockflow.llm.queries import QUERIES


def slow_fingerprint(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps, bits):
    """Root of each fingerprint, by comparing all pairs."""
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = sorted(parent)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if bin(a ^ b).count("1") <= bits:
                parent[find(b)] = find(a)
    return {f: find(f) for f in parent}


def slow_components(rows, bits):
    roots = slow_classes({f for _, f in rows}, bits)
    low = {}
    for i, f in rows:
        if i is not None:
            low[roots[f]] = min(i, low.get(roots[f], i))
    return {(i, f): low.get(roots[f]) for i, f in rows}


def signed(f):
    return int(np.uint64(f).astype(np.int64))


def test_whole_small_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    rows = [(r["doc_id"], slow_fingerprint(r["text"] or "")) for r in docs]
    want = slow_components(rows, 4)
    got = QUERIES["op2_simhash_near_dedup"](spark, sf_small).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in got} == want


def test_planted_distances_and_crowded_variants(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for centre in fps[:20]:  # chains and balls of near fingerprints
        for _ in range(25):
            f = centre
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << bit
            fps.append(f)
    ball = rng.getrandbits(64)
    fps += [ball ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]  # one crowded group
    frame = spark.createDataFrame([(signed(f),) for f in set(fps)], "fp long")
    want = slow_classes(set(fps), 4)
    for crowded in (4096, 64):  # without and with dealing into blocks
        links = simhash.links(frame, 4, crowded)
        pairs = links.collect()
        assert all(bin((p["a"] ^ p["b"]) & (2**64 - 1)).count("1") <= 4 for p in pairs)
        roots = {r["node"]: r["root"] for r in simhash.star_contraction(links).collect()}
        mine = {f: roots.get(signed(f), signed(f)) for f in want}
        groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
        assert groups(mine) == groups(want)


def test_a_dense_variant_gives_few_links():
    fps = np.array([1 << a | 1 << b for a in range(64) for b in range(a)], dtype=np.uint64)
    left, right = simhash.run_links(fps, 4)
    assert sum(map(len, left)) == len(fps) - 1


def test_every_split_of_differing_bits_meets_in_a_variant(spark):
    rng = random.Random(9)
    rows = []
    for k in range(200):
        f = rng.getrandbits(64)
        g = f
        for bit in rng.sample(range(64), 4):
            g ^= 1 << bit
        rows.append((signed(f), signed(g)))
    keys = lambda c: simhash.variant_keys(F.col(c), 4)
    met = spark.createDataFrame(rows, "a long, b long").where(F.arrays_overlap(keys("a"), keys("b")))
    assert met.count() == len(rows)


def test_large_classes_are_joined_in_pieces(spark):
    """A class of exact copies, one of near copies and single texts: the same
    result with every key whole and with keys of more than ten rows cut."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    same, near = " ".join(word() for _ in range(60)), [word() for _ in range(900)]
    texts = [same] * 400 + [" ".join([*near[:i], word(), *near[i + 1 :]]) for i in range(0, 900, 5)]
    texts += [" ".join(word() for _ in range(60)) for _ in range(100)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {tuple(r) for r in simhash.near_duplicates(docs, hot_rows=10**9).select("doc_id", "fp", "component_id").collect()}
    cut = simhash.near_duplicates(docs, hot_rows=10)
    rows = [tuple(r) for r in cut.select("doc_id", "fp", "component_id").collect()]
    assert len(rows) == len(texts) and set(rows) == whole
    fps = {simhash.simhash(t or "") for t in texts}
    classes = slow_classes(fps, 4)
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(classes[simhash.simhash(t or "")], i)
    assert {i: c for i, _, c in rows} == {i: first[classes[simhash.simhash(t or "")]] for i, t in enumerate(texts)}


def test_edges_and_keeping_one(spark, edge_docs, no_docs):
    got = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(edge_docs).collect()}
    by_id = {i: c for (i, _), c in got.items()}
    assert by_id[1] == by_id[2] == by_id[7] == 1  # no words: fingerprint zero
    assert by_id[3] == by_id[4] == 3
    assert got[(1, 0)] == 1 and by_id[5] == 5 and by_id[None] is None
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 1, 3, 5, 8]
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_counting_in_parts_changes_nothing(monkeypatch):
    text = " ".join(str(i * i) for i in range(3000))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 100)
    assert simhash.simhash(text) == whole == slow_fingerprint(text)
