"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to six classes: insult, threat, target ("you"), negation,
reported speech ("said") and other. Small transducers read the classes of one
clause: the negation, target and reported-speech transducers remember for some
words that one of their words came by, and the core transducer emits a match
at insults and threats. ``compose`` multiplies them into one table, so a clause
is scored in one walk: a match counts more near a target, less under negation
and in reported speech, a threat only with a target. Target words may also
follow their match. What is scored is the clause, not the word.

The insult words are learned: words far more frequent in toxic than in other
training documents, counted once per group of documents with the same smallest
word hash (near copies mostly share it, and so do other texts with that word: a
coarse group, which asks more of a word than four copies of one text); a word's first ``STEM`` letters are learned in the
same way, so inflected forms that were not seen count too. The threat, target, negation and reported-speech
words are short fixed lists in four languages. A logistic curve over the
document's clause scores gives the probability. Learning reads at most
``max_training`` labelled documents, picked by a hash of the id, never a
held-out one (``held_out``); label, language, source and id are no inputs of a
score.

Defined cases: null and empty texts have no matches and get the curve's base
value; several labels for one id count as toxic if any is; null labels and ids
take no part in learning; without any training documents the prior curve is
used; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text, materialize

#: Labelled documents that learning reads at most (about).
MAX_TRAINING = 20_000
#: What makes an insult word: groups of toxic documents that hold it, and its
#: log odds. All are kept; the training rows bound how many there can be.
LEAST_GROUPS = 4
LEAST_LOG_ODDS = 2.5
#: Words for which a target or a negation is remembered.
WINDOW = 4

#: Letters of a stem; it stands in the model with a star behind it.
STEM = 5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# The grammar's closed word classes in English, German, French, Spanish.
CLOSED_CLASSES = {
    THREAT: "kill hurt destroy beat stab shoot töten umbringen schlagen tuer tuerai frapper matar mataré golpear",
    TARGET: "you your yours yourself du dich dir ihr euch tu te toi vous tú ti usted ustedes",
    NEGATION: "not never no isn't aren't don't nicht nie kein keine pas jamais ne nunca",
    REPORT: "said says wrote called claimed quoted reported sagte schrieb behauptete dit écrit affirme dijo escribió",
}
# How much a match weighs by circumstances.
TARGETED, NEGATED, REPORTED, THREAT_WEIGHT = 1.5, 0.3, 0.5, 2.0

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer over word classes: ``step[state][class]`` is
    (next state, output). State 0 is the start."""

    step: tuple[tuple[tuple[int, float], ...], ...]


def memory(trigger: int, window: int, inside: float) -> Transducer:
    """Outputs ``inside`` for ``window`` words after a trigger, else 1."""
    return Transducer(
        tuple(
            tuple((window, 1.0) if c == trigger else (max(0, s - 1), inside if s else 1.0) for c in range(6))
            for s in range(window + 1)
        )
    )


def latch(trigger: int, inside: float) -> Transducer:
    """Outputs ``inside`` from the trigger to the clause's end."""
    return Transducer(tuple(tuple((1 if s or c == trigger else 0, inside if s else 1.0) for c in range(6)) for s in (0, 1)))


def core() -> Transducer:
    return Transducer((tuple((0, {INSULT: 1.0, THREAT: THREAT_WEIGHT}.get(c, 0.0)) for c in range(6)),))


def compose(*parts: Transducer) -> Transducer:
    """The parts side by side: states are tuples, outputs multiply."""
    states = list(product(*[range(len(p.step)) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    return Transducer(
        tuple(
            tuple(
                (
                    number[tuple(p.step[x][c][0] for p, x in zip(parts, s, strict=True))],
                    math.prod(p.step[x][c][1] for p, x in zip(parts, s, strict=True)),
                )
                for c in range(6)
            )
            for s in states
        )
    )


def grammar() -> Transducer:
    return compose(
        core(), memory(TARGET, WINDOW, TARGETED), memory(NEGATION, WINDOW, NEGATED), latch(REPORT, REPORTED)
    )


def outputs(machine: Transducer, kinds: list[int]) -> list[float]:
    """What the machine puts out at each word of one walk."""
    state, out = 0, []
    for kind in kinds:
        state, value = machine.step[state][kind]
        out.append(value)
    return out


_NEAR_TARGET = memory(TARGET, WINDOW, TARGETED)


def clause_score(words: list[str], classes: dict[str, int], weights: dict[str, float], table: Transducer) -> float:
    """A walk over the clause from each end, whatever its length: the composed
    table reads it forwards, the memory of targets backwards too, so that a
    target right after a match counts as one before it. A threat without a
    target in its clause is no match."""
    kinds = [classes.get(w) or classes.get(w[:STEM] + "*", OTHER) for w in words]
    if INSULT not in kinds and THREAT not in kinds:
        return 0.0
    targeted = TARGET in kinds
    before = outputs(_NEAR_TARGET, kinds)
    after = reversed(outputs(_NEAR_TARGET, kinds[::-1]))
    total = 0.0
    for word, kind, out, b, a in zip(words, kinds, outputs(table, kinds), before, after, strict=True):
        if not out or (kind == THREAT and not targeted):
            continue
        total += out * (weights.get(word) or weights.get(word[:STEM] + "*", 1.0)) * (a if b == 1.0 else 1.0)
    return total


@dataclass
class ToxicityModel:
    insults: dict[str, float] = field(default_factory=dict)
    # prior curve: one plain match of weight 1 lies at one half
    curve: tuple[float, ...] = (-3.0, 2.0, 1.0, 0.0)

    def classes(self) -> dict[str, int]:
        closed = {w: c for c, words in CLOSED_CLASSES.items() for w in words.split()}
        return {**{w: INSULT for w in self.insults}, **closed}


def features(text: str, classes, core_words: frozenset, weights, table: Transducer) -> tuple[float, float, float]:
    """(a match at all, largest clause score, log of all clause scores per
    hundred words)."""
    text = text.lower()
    words = _WORD.findall(text)
    if core_words.isdisjoint(words) and core_words.isdisjoint([w[:STEM] + "*" for w in words]):
        return 0.0, 0.0, 0.0
    scores = [clause_score(_WORD.findall(c), classes, weights, table) for c in _CLAUSE.split(text)]
    total = sum(scores)
    return float(total > 0), min(4.0, max(scores)), math.log1p(100 * total / len(words))


def _scored(docs: DataFrame, model: ToxicityModel, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = model.classes(), grammar()
        core_words = frozenset(w for w, c in classes.items() if c in (INSULT, THREAT))
        for batch in batches:
            rows = [features(t.as_py(), classes, core_words, model.insults, table) for t in batch["text"]]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "any", "top", "rate"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, any double, top double, rate double")


def held_out(doc_id: Column) -> Column:
    """The rows that learning never sees: a fifth, by the id's CRC."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_training: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, toxic): at most about ``max_training`` rows; the picked
    labels have that bound and are broadcast, so the texts stay in place."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, max_training / max(1, usable.count()))
    picked = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    return id_text(docs, id_col, text_col).join(F.broadcast(picked), "doc_id")


def learn_insults(rows: DataFrame) -> dict[str, float]:
    """Words whose log odds between toxic and other training documents are
    high, with weights near 1."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+(?:'\p{L}+)?)"), 1))
    stems = F.transform(F.filter("words", lambda w: F.length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*")))
    seen = rows.select("toxic", words.alias("words")).select(
        "toxic", "words", F.array_min(F.transform("words", lambda w: F.xxhash64(w))).alias("group"),
        F.array_union("words", stems).alias("terms"),
    )
    groups = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.countDistinct("group").alias("n")).collect()}
    if not groups.get(1) or not groups.get(0):
        return {}
    counts = (
        seen.select("toxic", "group", F.explode("terms").alias("word"))
        .distinct()
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))
    )
    odds = F.log((F.col("bad") + 0.5) / (groups[1] + 1.0)) - F.log((F.col("fine") + 0.5) / (groups[0] + 1.0))
    kept = (
        counts.where(F.col("bad") >= LEAST_GROUPS)
        .withColumn("odds", odds)
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .collect()
    )
    return {r["word"]: min(2.0, r["odds"] / 5) for r in kept}


def fit_curve(x: np.ndarray, y: np.ndarray, prior: tuple[float, ...], strength: float = 0.1) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn towards the prior curve."""
    x = np.column_stack([np.ones(len(x)), x])
    start = np.array(prior)
    w = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_training: int = MAX_TRAINING,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Learn the insult words and the curve from labels that are not held out."""
    rows = materialize(training_rows(docs, labels, max_training, id_col, text_col))
    model = ToxicityModel(insults=learn_insults(rows))
    marks = rows.select("doc_id", "toxic").distinct().join(_scored(rows, model, "doc_id", "text").distinct(), "doc_id")
    found = marks.select("any", "top", "rate", "toxic").toPandas().to_numpy(dtype=float)  # bounded by max_training
    if len(found) and 0 < found[:, 3].sum() < len(found):
        model.curve = fit_curve(found[:, :3], found[:, 3], model.curve)
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted)."""
    base, *weights = model.curve
    z = F.lit(base)
    for name, w in zip(("any", "top", "rate"), weights, strict=True):
        z = z + F.col(name) * F.lit(w)
    scored = _scored(docs, model, id_col, text_col).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the model doesn't reject, with all their columns, in
    one pass over the texts (nothing is shuffled)."""
    base, *weights = model.curve
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = model.classes(), grammar()
        core_words = frozenset(w for w, c in classes.items() if c in (INSULT, THREAT))
        at = columns.index(text_col)
        for batch in batches:
            z = [
                base + sum(w * f for w, f in zip(weights, features(t.as_py() or "", classes, core_words, model.insults, table), strict=True))
                for t in batch.column(at)
            ]
            yield batch.filter(pa.array([v < 0 for v in z], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
