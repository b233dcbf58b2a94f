import hashlib

from stockflow.llm import spotsigs
from stockflow.llm.queries import QUERIES


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_small_table_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    anchors = spotsigs.common_words(docs)
    got = {r["doc_id"]: r for r in QUERIES["op3_document_fingerprints"](spark, sf_small).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    assert sorted(got) == [i for i, _ in rows]
    signer = spotsigs.Signer(anchors)
    prints = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        n = len(text) // 4
        edit = text[: len(text) - n] + following[:n]
        own, other, nxt = (set(signer.signatures(t).tolist()) for t in (text, edit, following))
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert r["near_edited"] == jaccard(own, other) and r["near_next"] == jaccard(own, nxt)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.95 * len(got)


def test_every_language_brings_its_common_words(spark):
    """More languages than a hundred, one of them with a thousandth of the documents."""
    rows = [("big", "alpha beta gamma")] * 29_000 + [(None, "nolang nolang")] * 30 + [("few", "seldom")] * 29
    rows += [(f"l{k}", f"w{chr(97 + k // 26)}{chr(97 + k % 26)} x{chr(97 + k // 26)}{chr(97 + k % 26)}") for k in range(150) for _ in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = spotsigs.common_words(docs, n=1)
    want = {"alpha", "nolang"} | {f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(150)}
    assert got == sorted(want)
    assert "seldom" in spotsigs.common_words(docs, n=1, least_documents=29)
    assert spotsigs.common_words(docs, n=2, lang_col=None) == ["alpha", "beta"]


def test_bucket_count_changes_nothing(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = spotsigs.fingerprint_edits(docs, ["the", "de"]).collect()
            results.append(sorted(tuple(r) for r in rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2] and len(results[0]) == docs.count()


def test_edges(spark, edge_docs, no_docs):
    anchors = spotsigs.common_words(edge_docs)
    rows = spotsigs.fingerprint_edits(edge_docs, anchors).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 3, 4, 5, 7, 8]
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[1] == prints[2] and prints[3] == prints[4] != prints[8]
    assert {r["near_next"] for r in rows if r["doc_id"] == 1} == {1.0}  # two empty texts
    assert spotsigs.common_words(no_docs) == []
    assert spotsigs.fingerprint_edits(no_docs, []).count() == 0
    alone = edge_docs.where("doc_id = 8")
    assert [r["near_next"] for r in spotsigs.fingerprint_edits(alone, []).collect()] == [1.0]


def test_similar_documents_against_all_pairs(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    anchors = spotsigs.common_words(docs)
    for least in (0.8, 0.4):
        members, links = spotsigs.similar_documents(docs, anchors, least)
        set_of = {r["doc_id"]: r["set_id"] for r in members.collect()}
        got = {(r["a"], r["b"]): r["likeness"] for r in links.collect()}
        signer = spotsigs.Signer(anchors)
        sets = {set_of[r["doc_id"]]: set(signer.signatures(r["text"]).tolist()) for r in docs.collect()}
        ids = sorted(sets)
        want = {
            (a, b): jaccard(sets[a], sets[b]) for k, a in enumerate(ids) for b in ids[k + 1 :] if jaccard(sets[a], sets[b]) >= least
        }
        assert got == want and want
