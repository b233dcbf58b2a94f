import corpus_pipeline
from stockflow.llm import secrets, simhash, toxicity
from stockflow.llm.common import table


def test_each_decision_takes_effect(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    model = toxicity.fit(docs, table(spark, sf_small, "labels"))
    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_small)
    assert kept.columns == docs.columns
    clean = {r.doc_id for r in kept.select("doc_id").collect()}
    assert clean == {d for d, p in scored.items() if not p}
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept, words=4, max_bits=4).collect()}
    one = corpus_pipeline.drop_near_duplicates(spark, kept, sf_small)
    assert one.columns == docs.columns
    texts = {r.doc_id: r.text or "" for r in one.select("doc_id", "text").collect()}
    assert sorted(component[d] for d in texts) == sorted(set(component.values()))
    hidden = corpus_pipeline.mask_secrets(spark, one, sf_small)
    assert hidden.columns == docs.columns
    for r in hidden.select("doc_id", "text").collect():
        found = secrets.scan_text(texts[r.doc_id])[1]
        assert (r.text or "") == (secrets.masked(texts[r.doc_id], found, "[SECRET]") if found else texts[r.doc_id])
    packed = corpus_pipeline.run(spark, sf_small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts)
