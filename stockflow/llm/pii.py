"""Personal data: patterns, and terms that give a person's data away
(DataFrame functions only).

The pattern kinds (e-mail, IP, card, phone) are the protected entities. The
information-theoretic part looks at the words of the documents they stand in:
from the whole corpus it estimates how much of an entity's information a term
reveals,

    PMI(term; entity) = log2( N * n(term with entity) / (n(term) * n(entity)) )
    disclosure        = PMI / IC(entity),   IC(entity) = log2( N / n(entity) )

with n counted in documents. Disclosure is 1 when the term occurs nowhere but
with the entity, and about 0 for common words. The same is estimated for the
entity's kind (any e-mail, any phone number, ...) in the entity's place, so
that an entity seen only once has estimates too; the larger one counts. A term
whose disclosure is at least ``remove_from`` is removed, one from
``generalise_from`` on generalised (a placeholder for its class), wherever it
stands in a document with the entity. An estimate counts only with ``support``
different contexts, so copies of one text, however many, are no evidence: the
documents whose ``SKETCH`` smallest hashes of two adjoining words are the same
are one context.

Defined cases: null text is empty text and has no spans; positions are code
points, ends exclusive; repeated rows are scanned each; null ids are kept; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
# The kinds' patterns. Possessive repeats match what greedy ones
# would here and don't recurse; the look-behinds skip starts that cannot be
# leftmost, so that long runs aren't searched again from each of their letters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
_NEEDED = {"email": "@", "phone": "+"}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Least letters of a term, and how many hashes of word pairs tell documents apart.
TERM_LEAST = 3
SKETCH = 8
SUPPORT = 3
GENERALISE_FROM = 0.5
REMOVE_FROM = 0.8

# Stands for a letter of an e-mail, which no term may hold or touch.
_COVER = "\uffff"
_TERM = rf"(?<![\p{{L}}{_COVER}])\p{{L}}{{{TERM_LEAST},}}+(?!{_COVER})"

#: Matches of a text that are placed at once.
RUN = 256

SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


MATCH = "struct<start:bigint,end:bigint,value:string>"


def _placed(pairs: Column) -> Column:
    """(end, spans) of (gap, value) pairs that follow each other from 0 on."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{MATCH}>").alias("out"))

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        end = start + F.char_length(item["value"])
        span = F.struct(start.alias("start"), end.alias("end"), item["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    return F.aggregate(pairs, begin, step)


def _placed_by_runs(pairs: Column) -> Column:
    """The spans of many pairs: each run of ``RUN`` of them is placed from 0 on
    and then moved to where the run before it ends. Appending copies an array,
    so it is done to short arrays only, and the runs' ends are summed up run by
    run: a text of n matches costs about n * RUN + (n / RUN) ** 2 / 2 copied
    entries and not n ** 2 / 2."""
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / RUN).cast("int")),
        lambda i: _placed(F.slice(pairs, i * RUN + 1, F.lit(RUN))),
    )
    begins = F.aggregate(
        runs,
        F.array(F.lit(0).cast("long")),
        lambda ends, run: F.array_append(ends, F.element_at(ends, -1) + run["at"]),
    )
    moved = F.zip_with(
        runs,
        begins,
        lambda run, by: F.transform(
            run["out"],
            lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value")),
        ),
    )
    # there is one begin more than runs, and its entry is null
    return F.flatten(F.filter(moved, lambda spans: spans.isNotNull()))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the pattern's matches, leftmost and not
    overlapping: the matches and the gaps between them alternate."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g).cast("long"))
    pairs = F.zip_with(
        found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(g.alias("gap"), m.alias("value"))
    )
    # a value of its own, so that each use of it below doesn't search the text again
    once = lambda then: F.element_at(F.transform(F.array(pairs), then), 1)
    spans = once(lambda p: F.when(F.size(p) > RUN, _placed_by_runs(p)).otherwise(_placed(p)["out"]))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(f"array<{MATCH}>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' check digit is right."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def kind_spans(text: Column, number: int) -> Column:
    """Array of (start, kind number, end, value) of one kind."""
    kind = KINDS[number]
    worth = text.contains(_NEEDED[kind]) if kind in _NEEDED else text.rlike("[0-9]")
    kept = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
    spans = F.transform(
        kept,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["value"].alias("value")
        ),
    ).cast(f"array<{SPAN}>")
    return F.when(worth, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def entity_spans(text: Column) -> Column:
    """Array of (start, kind number, end, value) of all kinds, sorted."""
    return F.array_sort(F.concat(*[kind_spans(text, n) for n in range(len(KINDS))]))


def _covered(text: Column) -> Column:
    """The text with the letters of its e-mails covered; the other kinds have
    none. Positions stay the same."""
    pattern = PATTERNS["email"]
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, mail: F.concat(gap, F.coalesce(F.regexp_replace(mail, r"\p{L}", _COVER), F.lit(""))),
    )
    return F.when(text.contains(_NEEDED["email"]), F.array_join(pieces, "")).otherwise(text)


def _words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _distinct_terms(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.transform(_words(text, pattern), F.lower))


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, base, around): the entity spans and, where there are any,
    the text with its e-mails covered."""
    clean = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    text = F.col("text")
    around = F.when(F.size("base") > 0, _covered(text)).alias("around")
    return clean.withColumn("base", entity_spans(text)).select("row", "doc_id", "base", around)


def find_mentions(found: DataFrame, support: int) -> DataFrame:
    """(row, entity, term, context): the terms of each document with an entity,
    for its kinds and for those entities that occur in ``support`` documents
    (the others can't have as many contexts)."""
    held = found.where(F.size("base") > 0)
    kinds = F.transform(F.array_distinct(F.col("base.kind")), lambda k: k.cast("string"))
    values = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    each = held.select("row", F.explode(values).alias("entity"))
    often = each.groupBy("entity").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= support).select("entity")
    per_row = each.join(often, "entity").groupBy("row").agg(F.collect_list("entity").alias("often"))
    words = held.select("row", kinds.alias("kinds"), F.transform(_words(F.col("around"), _TERM), F.lower).alias("words"))
    follow = F.transform("words", lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1)))
    context = F.xxhash64(F.slice(F.array_sort(F.array_distinct(follow)), 1, SKETCH))
    terms = words.select("row", "kinds", F.array_distinct("words").alias("terms"), context.alias("context"))
    entities = F.concat("kinds", F.coalesce("often", F.array().cast("array<string>")))
    return (
        terms.join(per_row, "row", "left")
        .select("row", "context", "terms", F.explode(entities).alias("entity"))
        .select("row", "entity", F.explode("terms").alias("term"), "context")
    )


def disclosing_terms(
    docs: DataFrame, mentions: DataFrame, support: int, least: float, text_col: str
) -> DataFrame:
    """(entity, term, disclosure) for all pairs at or above ``least``.
    ``mentions`` has a row (row, entity, term, context) per entity or kind and
    term of a document."""
    total = docs.count()
    pairs = (
        mentions.groupBy("entity", "term", "context")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("contexts"), F.sum("rows").alias("n_near"))
        .where(F.col("contexts") >= support)
    )
    wanted = pairs.select("term").distinct()
    words = _distinct_terms(F.col(text_col), rf"\p{{L}}{{{TERM_LEAST},}}+")
    # counted before the join, so that a common word is combined map-side
    seen = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(wanted, "term")
    entities = mentions.select("entity", "row").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    n = F.lit(float(max(total, 1)))
    pmi = F.log2(n * F.col("n_near") / (F.col("n_term") * F.col("n_entity")))
    ic = F.log2(n / F.col("n_entity"))
    return (
        pairs.join(entities, "entity")
        .join(seen, "term")
        .where(ic > 0)
        .select("entity", "term", (pmi / ic).alias("disclosure"))
        .where(F.col("disclosure") >= least)
    )


def term_places(texts: DataFrame, telling: DataFrame) -> DataFrame:
    """(row, start, end, term, disclosure) of each place of the ``telling``
    (row, term, disclosure) terms in ``texts`` (row, around)."""
    words = _words(F.col("around"), _TERM)
    gaps = F.slice(F.split("around", _TERM, -1), F.lit(1), F.size(words))
    pairs = F.zip_with(gaps, words, lambda g, w: F.struct(F.char_length(g).alias("gap"), w.alias("word")))
    size = F.char_length("w.word")
    end = F.sum(F.col("w.gap") + size).over(Window.partitionBy("row").orderBy("at"))
    return (
        texts.join(telling.select("row").distinct(), "row", "left_semi")
        .select("row", F.posexplode(pairs).alias("at", "w"))
        .select("row", (end - size).alias("start"), end.alias("end"), F.lower("w.word").alias("term"))
        .join(telling, ["row", "term"])
    )


def find_personal_data(
    docs: DataFrame,
    support: int = SUPPORT,
    generalise_from: float = GENERALISE_FROM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, base, terms): entity spans, and the spans of the terms to be
    generalised or removed as (start, end, term, disclosure)."""
    found = materialize(find_entities(docs, id_col, text_col))
    mentions = find_mentions(found, support)
    pairs = disclosing_terms(docs, mentions, support, generalise_from, text_col)
    telling = mentions.join(pairs, ["entity", "term"]).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    per_row = (
        term_places(found.where(F.size("base") > 0).select("row", "around"), materialize(telling))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "term", "disclosure"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,term:string,disclosure:double>>")
    return found.join(per_row, "row", "left").select("doc_id", "base", F.coalesce("terms", none).alias("terms"), "row")


def all_spans(base: Column, terms: Column) -> Column:
    """Entity and term spans together as (start, kind number, end), sorted; a
    term's kind number follows the entities'."""
    entity = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    term = F.transform(
        terms, lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end"))
    )
    return F.array_sort(F.concat(entity, term))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, "term")))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def sanitise(text: Column, base: Column, terms: Column, remove_from: float = REMOVE_FROM) -> Column:
    """The text with entities replaced by their kind, terms generalised to a
    placeholder or, from ``remove_from`` on, removed. Of overlapping spans the
    first decides."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    entity = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("put")))
    term = F.transform(
        terms,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.when(s["disclosure"] >= remove_from, "").otherwise("[TERM]").alias("put")
        ),
    )
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    between = lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int"))

    def step(state: Column, s: Column) -> Column:
        new = F.struct(s["end"].alias("at"), F.concat(state["out"], between(state["at"], s["start"]), s["put"]).alias("out"))
        return F.when(s["start"] >= state["at"], new).otherwise(state)

    spans = F.array_sort(F.concat(entity, term))
    return F.aggregate(
        spans, begin, step, lambda s: F.concat(s["out"], between(s["at"], F.char_length(text).cast("long")))
    )
