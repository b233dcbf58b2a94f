"""run() against slow versions that use none of the library's own steps."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_simhash import slow_components, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from stockflow.llm import toxicity
from stockflow.llm.common import table

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base_secrets(text):
    yield from (m.group(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12)
    yield from (m.group() for m in ACCESS.finditer(text) if len(m.group()) >= 18)
    yield from (m.group() for m in HEX.finditer(text) if len(m.group()) >= 16)


def slow_pieces(doc_id, text, tokenizer, capacity=1024):
    """(doc_id, piece, start, length, ids_crc32) of one document, in order."""
    ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    for k, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
        yield doc_id, k, start, end - start, zlib.crc32(np.array(ids[start:end], dtype="<u4").tobytes())


def lengths_of(packed):
    return sorted((r.doc_id or -1, r.piece, r.length) for r in packed.collect())


def gapless(rows, capacity=1024):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


def put(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_against_slow_versions(spark, sf_small, bpe_path):
    docs = table(spark, sf_small, "documents")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_small).collect()
    marked = [(r.doc_id, slow_fingerprint(r.text or "")) for r in kept]
    component = {d: c for (d, _), c in slow_components(marked, 4).items()}
    one = {r.doc_id: r.text or "" for r in kept if component[r.doc_id] == r.doc_id}
    rows = corpus_pipeline.run(spark, sf_small).collect()
    assert {r.doc_id for r in rows} == set(one)
    gapless(rows)
    tokenizer = Tokenizer.from_file(bpe_path)
    plain = {d: t for d, t in one.items() if not any(base_secrets(t))}
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    same = [d for d, t in plain.items() if sorted(got[d]) == list(slow_pieces(d, t, tokenizer))]
    # a document without a base secret changes only where the method finds a further one
    further = set(plain) - set(same)
    stage = {r.doc_id: r.text for r in corpus_pipeline.mask_secrets(spark, docs, sf_small).collect()}
    assert all("[SECRET]" in stage[d] for d in further)
    for d, t in one.items():
        assert sorted(got[d]) == list(slow_pieces(d, stage[d] or "", tokenizer))
        for secret in base_secrets(t):
            assert secret not in (stage[d] or "")


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_rows(spark, edge_docs, sf_small, tmp_path, labelled):
    labels = table(spark, sf_small, "labels")
    sf_dir = put(spark, tmp_path, edge_docs, labels if labelled else labels.limit(0))
    packed = corpus_pipeline.run(spark, sf_dir)
    gapless(packed.collect())
    ids = {r.doc_id for r in packed.collect()}
    # one of the empty texts, one of the equal sentences, the long text, the row without an id, the last
    assert ids == {1, 3, 5, None, 8}
    before = lengths_of(packed)
    corpus_pipeline.run(spark, sf_dir)
    assert lengths_of(packed) == before


def test_stages_keep_extra_columns(spark, edge_docs, sf_small, tmp_path):
    sf_dir = put(spark, tmp_path, edge_docs, table(spark, sf_small, "labels"))
    docs = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert out.where(F.col("dir") != "x").count() == 0


def test_empty_tables(spark, no_docs, sf_small, tmp_path):
    sf_dir = put(spark, tmp_path, no_docs, table(spark, sf_small, "labels").limit(0))
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_without_labels_the_prior_curve_decides(spark, sf_small, tmp_path):
    text = ["you are an idiot and a moron", "a quiet town by the river with a market on the square"]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(text)], "doc_id long, text string, lang string, source string, n_chars long")
    sf_dir = put(spark, tmp_path, docs, table(spark, sf_small, "labels").limit(0))
    read = table(spark, sf_dir, "documents")
    scored = {r.doc_id: r.predicted for r in toxicity.score(read, toxicity.fit(read, table(spark, sf_dir, "labels"))).collect()}
    left = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert left == {d for d, p in scored.items() if not p} and 1 in left
