"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from stockflow.llm import quality

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

COLLOCATIONS = f"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, {_LOWERED} AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs),
lists AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (
  SELECT lang, w, k.k AS k, unnest(range(1, len(w) - k.k + 2)) AS s
  FROM lists, (SELECT unnest(range(1, 5)) AS k) k WHERE len(w) >= k.k
),
counted AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL
),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
cuts AS (
  SELECT lang, phrase, f AS a, w, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM frequent WHERE k >= 2)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, h.f AS l, r.f AS r,
    ((2000000::HUGEINT * c.a) // (h.f::HUGEINT + r.f))::BIGINT AS score
  FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head
  JOIN frequent r ON r.lang = c.lang AND r.phrase = c.rest
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
inner_phrases AS (
  SELECT lang, f, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS s
        FROM (SELECT *, unnest(range(2, k)) AS m FROM frequent WHERE k >= 3))
),
longest AS (SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT x.* FROM lowest x LEFT JOIN longest y ON x.lang = y.lang AND x.phrase = y.phrase
  WHERE y.f IS NULL OR 100::HUGEINT * y.f < 80::HUGEINT * x.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


def _texts(values) -> str:
    """A list literal."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_BLANK = r"[\x20\x09-\x0D]"

QUALITY = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, doc_id, t, list_filter(string_split_regex(t, '{_BLANK}+'), lambda x: x <> '') AS w FROM docs
),
windows AS (
  SELECT rid, s, w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS s FROM split WHERE len(w) >= 3)
),
again AS (SELECT rid, s FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeated AS (
  SELECT rid, count(DISTINCT s + k)::BIGINT AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
),
lines AS (
  SELECT rid, line, list_filter(string_split_regex(line, '{_BLANK}+'), lambda x: x <> '') AS w,
    translate(line, '{_UPPER}', '{_UPPER.lower()}') AS low
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
),
counted AS (
  SELECT rid, line, low, len(w) AS n, len(array_to_string(w, '')) AS chars,
    len(regexp_extract_all(line, '[#*$%&<>]+|[!?]{{2,}}')) AS marks,
    regexp_matches(line, '[.!?:;,…]["\\x27”’»)\\]]*{_BLANK}*$') AS ended,
    len(list_filter(w, lambda x: list_contains({_texts(quality.NAVIGATION_MARKS)}, x))) AS separators,
    len(list_filter(w, lambda x: NOT list_contains({_texts(quality.MENU_WORDS)},
      trim(translate(x, '{_UPPER}', '{_UPPER.lower()}'), '.,:;!?')))) = 0 AS menu,
    len(list_filter({_texts(quality.NOTICES)}, lambda x: contains(low, x))) > 0 AS notice,
    len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS stutters
  FROM lines WHERE len(w) > 0
),
lost AS (
  SELECT rid, sum(chars)::BIGINT AS chars FROM counted
  WHERE 100 * marks > {quality.MARKS} * n OR (n < {quality.SHORT_LINE} AND NOT ended)
    OR (separators >= 2 AND 100 * separators > {quality.SEPARATORS} * n) OR menu
    OR (n <= {quality.NOTICE_WORDS} AND notice) OR 100 * stutters > {quality.STUTTER} * n
  GROUP BY rid
),
duplicates AS (SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n FROM counted GROUP BY rid),
base AS (
  SELECT s.rid, s.doc_id, len(s.w)::BIGINT AS n_words, len(array_to_string(s.w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(s.t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(l.chars, 0) AS lost
  FROM split s LEFT JOIN duplicates d USING (rid) LEFT JOIN repeated r USING (rid) LEFT JOIN lost l USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
  NOT base_failed AND 100 * lost <= {quality.MAX_LOSS} * word_chars AS kept
FROM base
"""

# The CRC's table is built by its rule, bit by bit; all letters here are ASCII or two bytes long (U+00C0 to U+00FF).
SPELLING = f"""
WITH RECURSIVE bits AS (
  SELECT i AS place, i::BIGINT AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT place, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY place) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]+')) AS r FROM documents)
  WHERE len(r) >= 6 GROUP BY ALL
),
hashed AS (
  SELECT r, n, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || r, ''),
      lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, (ord(x) - 64)::BIGINT] END)),
    lambda acc, x: xor(acc >> 8, t[xor(acc & 255, x) + 1]), 4294967295::BIGINT)) AS h
  FROM runs, crc
),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN r[:h % len(r)] || r[h % len(r) + 2:] ELSE r END AS word, n FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
holes AS (SELECT word, n, s, word[:s - 1] AS a, word[s + 1:] AS b FROM (SELECT *, unnest(range(1, len(word) + 1)) AS s FROM words)),
near AS (
  SELECT DISTINCT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.s = y.s AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION
  SELECT DISTINCT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.a || h.b
  UNION
  SELECT DISTINCT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.a || h.b
),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, struct_pack(n := -n, o := other)) AS other FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 5 * w.n THEN b.other END AS form,
    CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
ways AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS last FROM formed
  UNION ALL
  SELECT w.word, coalesce(f.form, f.word), f.form IS NULL FROM ways w JOIN formed f ON f.word = w.root WHERE NOT w.last
)
SELECT f.word, f.form, w.root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN ways w ON w.word = f.word AND w.last
"""

ORACLE_SQL = {
    "op11_collocations": COLLOCATIONS,
    "op12_quality_rules": QUALITY,
    "op13_spelling_variants": SPELLING,
}
