import zlib
from collections import Counter, defaultdict

from stockflow.llm import sharding
from stockflow.llm.queries import QUERIES


def check(rows, texts, shards, key=lambda r: r.doc_id):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / shards
    assert all(abs(sizes[s] - mean) <= max(r.size for r in rows) for s in range(shards))


def test_whole_small_table(spark, sf_small):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op8_sharding"](spark, sf_small).collect(), texts, 16)


def test_edge_rows(edge_docs, no_docs):
    texts = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    check(sharding.assign_shards(sharding.shard_records(edge_docs), shards=3).collect(), texts, 3)
    assert sharding.assign_shards(sharding.shard_records(no_docs), shards=3).count() == 0


def test_a_hot_text_is_spread(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(sharding.assign_shards(sharding.shard_records(docs), shards=16).collect(), rows, 16)
