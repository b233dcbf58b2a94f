import random
import zlib

import pytest
from pyspark.sql import functions as F

from stockflow.llm import toxicity
from stockflow.llm.queries import QUERIES

MODEL = toxicity.ToxicityModel(insults={"idiot": 1.0, "scum": 1.0, "worth*": 1.0})


def clause(text, model=MODEL):
    return toxicity.clause_score(text.lower().split(), model.classes(), model.insults, toxicity.grammar())


def test_circumstances_change_a_match():
    plain = clause("what an idiot lives there")
    assert plain == 1.0
    assert clause("you are an idiot") == clause("idiot that you are") == toxicity.TARGETED
    assert clause("that is not an idiot") == pytest.approx(toxicity.NEGATED)
    assert clause("she said what an idiot") == pytest.approx(toxicity.REPORTED)
    assert clause("she said you are not an idiot") == pytest.approx(
        toxicity.REPORTED * toxicity.TARGETED * toxicity.NEGATED
    )
    assert clause("not in this long and winding clause an idiot") == 1.0  # the negation is too far off


def test_threats_need_a_target_and_stems_count():
    assert clause("they kill weeds") == 0
    assert clause("they will kill you") == toxicity.THREAT_WEIGHT * toxicity.TARGETED
    assert clause("a worthless thing") == 1.0


def slow_clause(words, classes, weights):
    """The rules, looked up word by word around each match."""
    kind = lambda w: classes.get(w) or classes.get(w[: toxicity.STEM] + "*", toxicity.OTHER)
    near = lambda part, k: any(kind(w) == k for w in part)
    total = 0.0
    for i, word in enumerate(words):
        score = {toxicity.INSULT: 1.0, toxicity.THREAT: toxicity.THREAT_WEIGHT}.get(kind(word), 0.0)
        if kind(word) == toxicity.THREAT and not near(words, toxicity.TARGET):
            score = 0.0
        score *= weights.get(word) or weights.get(word[: toxicity.STEM] + "*", 1.0)
        if near(words[max(0, i - toxicity.WINDOW) : i] + words[i + 1 : i + 1 + toxicity.WINDOW], toxicity.TARGET):
            score *= toxicity.TARGETED
        # a negation is remembered for as many words as a target, a report to the clause's end
        if near(words[max(0, i - toxicity.WINDOW) : i], toxicity.NEGATION):
            score *= toxicity.NEGATED
        if near(words[:i], toxicity.REPORT):
            score *= toxicity.REPORTED
        total += score
    return total


def test_scores_equal_the_rules_looked_up():
    model = toxicity.ToxicityModel(insults={"idiot": 1.3, "scum": 0.7, "worth*": 1.1})
    rng = random.Random(2)
    words = "idiot scum worthless kill hurt you your not never said wrote a b c d e f g".split()
    matched = 0
    for _ in range(3000):
        held = rng.choices(words, k=rng.randint(0, 14))
        want = slow_clause(held, model.classes(), model.insults)
        assert clause(" ".join(held), model) == pytest.approx(want, rel=1e-12), held
        matched += want > 0
    assert matched > 1000


def test_a_clause_of_any_length_is_walked_a_fixed_number_of_times():
    steps = []

    class Counted(tuple):
        def __getitem__(self, i):
            steps.append(i)
            return super().__getitem__(i)

    table = toxicity.Transducer(Counted(toxicity.grammar().step))
    counts = []
    for n in (1000, 2000):
        steps.clear()
        words = "you idiot".split() * n
        toxicity.clause_score(words, MODEL.classes(), MODEL.insults, table)
        counts.append(len(steps))
    assert counts == [2000, 4000]


def test_composition_is_the_product_of_its_parts():
    parts = [toxicity.core(), toxicity.memory(toxicity.TARGET, 2, 3.0), toxicity.latch(toxicity.REPORT, 0.5)]
    table = toxicity.compose(*parts)
    assert len(table.step) == 1 * 3 * 2
    kinds = [toxicity.TARGET, toxicity.REPORT, toxicity.INSULT, toxicity.OTHER, toxicity.INSULT]
    states, state = [0, 0, 0], 0
    for k in kinds:
        want = 1.0
        for i, part in enumerate(parts):
            states[i], out = part.step[states[i]][k]
            want *= out
        state, got = table.step[state][k]
        assert got == want


def test_held_out_follows_the_id(spark):
    rows = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op4_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    bad, fine = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert len(bad) > 50 and sum(r["predicted"] for r in bad) >= 0.85 * len(bad)
    assert sum(r["predicted"] for r in fine) <= 0.01 * len(fine)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_labels_of_held_out_rows_change_nothing(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_edges(spark, edge_docs, no_docs):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(edge_docs, no_labels) == toxicity.fit(no_docs, no_labels) == toxicity.ToxicityModel()
    odd = spark.createDataFrame([(3, 0, 1), (3, 0, None), (8, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    toxicity.fit(edge_docs, odd)
    rows = toxicity.score(edge_docs, MODEL).collect()
    assert len(rows) == 9 and all(0 < r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert toxicity.drop_toxic(edge_docs, MODEL).collect() == edge_docs.collect()
    assert toxicity.score(no_docs, MODEL).count() == toxicity.drop_toxic(no_docs, MODEL).count() == 0
    bad = spark.createDataFrame([(1, "You are an idiot. Scum!"), (2, "fine")], "doc_id long, text string")
    assert [r["doc_id"] for r in toxicity.drop_toxic(bad, MODEL).collect()] == [2]


def test_every_insult_word_is_kept(spark):
    import random

    pick = random.Random(6)
    words = [f"{a}{b}{c}w" for a in "bcdfgklmnprst" for b in "aeiouy" for c in "bcdfghjklmnpqrstvwxzaeiouyßäöüéèà"]
    rows = [(1, " ".join(pick.sample(words, len(words) // 2))) for _ in range(120)]
    rows += [(0, f"{a}{b}one {b}{a}two") for a in "abcdefghijkl" for b in "mnopqrstuv"]
    found = toxicity.learn_insults(spark.createDataFrame(rows, "toxic int, text string"))
    assert len([w for w in found if not w.endswith("*")]) > 0.9 * len(words)
    assert len(found) > 2000
