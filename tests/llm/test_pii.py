import hashlib
import re

from stockflow.llm import pii
from stockflow.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain_spans(text):
    """The base spans straight from the contract's patterns."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    ]
    found = [
        (m.start(), n, name, m.end()) for n, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0])
    ]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_query_equals_brute_force(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op10_personal_data"](spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    seen = 0
    for r in rows:
        want = plain_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), r.doc_id
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in pii.KINDS)
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        seen += len(want)
    assert seen


def test_edge_rows(edge_docs, no_docs):
    rows = pii.find_personal_data(edge_docs).collect()
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    assert len(rows) == edge_docs.count()
    for r in rows:
        got = [(pii.KINDS[s.kind], s.start, s.end) for s in r.base]
        assert got == plain_spans(texts[r.doc_id]), r.doc_id
    assert pii.find_personal_data(no_docs).count() == 0


def test_texts_with_very_many_matches(spark):
    """Around the number of matches that are placed at once, and far above it:
    the cost must not grow with the square of their number."""
    line = lambda i: f"é😀{i} a{i}@b.co {i % 300}.0.0.1 +1234567{i:05d} 4111 1111 1111 1111;"
    texts = {n: "\n".join(map(line, range(n))) for n in (1, pii.RUN - 1, pii.RUN, pii.RUN + 1, 2 * pii.RUN, 2 * pii.RUN + 1, 10_000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.find_entities(docs).collect():
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in r.base] == plain_spans(texts[r.doc_id]), r.doc_id
        assert all(texts[r.doc_id][s.start : s.end] == s.value for s in r.base)


def planted_names():
    """Documents of which some hold planted names with personal data."""
    filler = [f"the {w}word and th{w} of it" for w in "abcdefghijklmnopqrstuvwxyz"]
    rest = [" ".join([filler[i % 26], filler[(i * 7 + 1) % 26], f"paper {i}"]) for i in range(200)]
    far = " the and of it" * 30
    texts = {
        # always the same address, beside it, far from it, and at the text's edges
        1: f"Marlowe can be asked.{far} Write to one@mail.example",
        2: f"One may write to one@mail.example{far} if it is for MARLOWE",
        3: "the mail one@mail.example of Marlowe, and Marlowe again",
        # each number is seen once; the name stands with numbers only
        4: f"Okonkwo{far} +1 (017) 555-7713",
        5: "it is okonkwo's: +1 (974) 555-3436",
        6: f"+1 (487) 555-7209{far} Okonkwo",
        # copies of one text are no evidence
        **{n: "dear Vesper, your card is 4111 1111 1111 1111" for n in (7, 8, 9, 10)},
        # the name inside an address is no term
        11: "the address éone@mail.example and marlowe@mail.example",
    }
    texts.update({100 + i: t for i, t in enumerate(rest)})
    return texts


def test_planted_names(spark):
    texts = planted_names()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert sorted(got) == sorted(texts)
    for name, where in (("marlowe", (1, 2, 3)), ("okonkwo", (4, 5, 6)), ("vesper", ())):
        for doc_id, text in texts.items():
            places = [m.span() for m in re.finditer(name, text, re.I)] if doc_id in where else []
            assert [(t.start, t.end) for t in got[doc_id].terms if t.term == name] == places, (name, doc_id)
            assert all(t.disclosure >= pii.GENERALISE_FROM for t in got[doc_id].terms)
    flagged = {t.term for r in got.values() for t in r.terms}
    assert not flagged & {"the", "and", "paper"}
    assert all(not got[d].terms for d in got if d >= 100)
