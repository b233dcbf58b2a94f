"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by path.

Headers may stand anywhere in a file: its lines, and groups of up to ``GROUP``
adjoining sentences or parts of lines, are compared with short licence templates
as sparse TF-IDF vectors; of overlapping matches the best is kept. The file as a
whole is compared with the short templates and with full licence texts. From
``FULL_THRESHOLD`` on a full text decides over the lines in it. Inverse
document frequencies of the templates' terms are counted over all files; terms
that no template has get the highest one, so unrelated words lower a cosine.
Lines and files that cannot reach the threshold are passed over by a bound: a
line without any of a template's rarer terms can at most reach the cosine of
that template's common part.

A file is a licence file by its name (LICENSE, COPYING, NOTICE, ...) or when it
as a whole resembles a template. A file without a licence of its own inherits
from the nearest directory above it that holds a licence file. That is resolved
per directory: each distinct directory is joined with the licensed ones through
its ancestors' paths, and files join their directory's result, so neither depth
nor a directory with very many files multiplies the files' rows.

Defined cases: null text is empty text and has no licence of its own; a null
path is the file "" in the root; of several licence files in one directory the
best score wins, then the smaller licence name; repeated rows are scanned each;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import materialize

LINE_THRESHOLD = 0.6
FILE_THRESHOLD = 0.6
FULL_THRESHOLD = 0.9
#: Adjoining sentences or parts of lines that are compared as one.
GROUP = 4

# Short notices by which licences are commonly declared.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License", "The MIT License (MIT)"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License version 3 or later",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "GNU General Public License version 2"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved."],
}
_TERM = re.compile(r"[^\W_]+(?:\.\d+)*")
_LICENCE_NAME = r"(?i)(^|/)(un)?licen[sc]e[^/]*$|(^|/)(copying|notice|copyright)[^/]*$"


_SENTENCE = re.compile(r"[.;!?][ \t]+")


@cache
def full_texts() -> dict[str, list[str]]:
    """The full licence texts that come with the package."""
    folder = files(__package__) / "licence_texts"
    return {f.name.removesuffix(".txt"): [f.read_text()] for f in folder.iterdir() if f.name.endswith(".txt")}


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def vocabulary(templates: dict[str, list[str]]) -> set[str]:
    return {t for notices in templates.values() for n in notices for t in terms(n)}


def without_overlap(matches: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
    """The matches that overlap none kept before them, by place. The kept ones
    lie in order, so a match is only held against its two neighbours."""
    kept: list[tuple[str, float, int, int]] = []
    for match in matches:
        _, _, start, end = match
        at = bisect_left(kept, start, key=lambda k: k[2])
        if (at == len(kept) or kept[at][2] >= end) and (at == 0 or kept[at - 1][3] <= start):
            kept.insert(at, match)
    return kept


class Matcher:
    """Cosines of texts to the templates."""

    def __init__(self, frequencies: dict[str, int], files: int, templates: dict[str, list[str]], least: float):
        top = math.log((1 + files) / 1) + 1
        self.idf = {t: math.log((1 + files) / (1 + frequencies.get(t, 0))) + 1 for t in vocabulary(templates)}
        self.other = top
        self.templates = []
        for name in sorted(templates):
            for notice in templates[name]:
                weights = {t: n * self.idf[t] for t, n in Counter(terms(notice)).items()}
                norm = math.sqrt(sum(w * w for w in weights.values()))
                self.templates.append((name, {t: w / norm for t, w in weights.items()}))
        # a text without these terms stays under the threshold for every template
        self.rare: set[str] = set()
        for _, weights in self.templates:
            common = 0.0
            for t, w in sorted(weights.items(), key=lambda x: (x[1], x[0])):
                common += w * w
                if math.sqrt(common) >= least:
                    self.rare.add(t)

    def best(self, counts: Counter) -> tuple[str | None, float]:
        """The best template's licence and cosine; ties to the smaller name."""
        norm = math.sqrt(sum((n * self.idf.get(t, self.other)) ** 2 for t, n in counts.items()))
        found: tuple[str | None, float] = (None, 0.0)
        for name, weights in self.templates:
            dot = sum(w * counts[t] * self.idf[t] for t, w in weights.items() if t in counts)
            if dot and dot / norm > found[1] + 1e-12:
                found = (name, dot / norm)
        return found

    def headers(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, cosine, start, end) of each match in the text."""
        pieces: list[tuple[list[str], int, int]] = []  # sentences and parts of lines that hold terms
        groups: list[tuple[list[str], int, int]] = []
        at = 0
        for line in text.split("\n"):
            own, start = terms(line), 0
            cuts = [*_SENTENCE.finditer(line), None]
            if len(cuts) > GROUP + 1:  # a shorter line is a group of its pieces
                groups.append((own, at, at + len(line)))
            for cut in cuts:
                end = cut.start() + 1 if cut else len(line)
                if held := terms(line[start:end]):
                    pieces.append((held, at + start, at + end))
                start = cut.end() if cut else end
            at += len(line) + 1
        for i in range(len(pieces)):
            held = []
            for own, _, end in pieces[i : i + GROUP]:
                held = held + own
                groups.append((held, pieces[i][1], end))
        found = []
        for held, start, end in groups:
            if not self.rare.isdisjoint(held):
                name, score = self.best(Counter(held))
                if score >= LINE_THRESHOLD:
                    found.append((name, score, start, end))
        return without_overlap(sorted(found, key=lambda m: (-round(m[1], 9), m[3] - m[2], m[2])))


class Scanner:
    """Short notices in a text, and what the text is as a whole."""

    def __init__(self, frequencies: dict[str, int], files: int, texts: dict[str, list[str]]):
        self.notices = Matcher(frequencies, files, TEMPLATES, min(LINE_THRESHOLD, FILE_THRESHOLD))
        self.full = Matcher(frequencies, files, texts, FULL_THRESHOLD)

    def scan(self, text: str) -> tuple[list[tuple[str, float, int, int]], tuple[str | None, float], bool]:
        """(headers, the whole file's best licence and cosine, whether that is a
        full text)."""
        words = terms(text)
        whole: tuple[str | None, float] = (None, 0.0)
        lines = []
        if not self.notices.rare.isdisjoint(words):
            lines, whole = self.notices.headers(text), self.notices.best(Counter(words))
        if not self.full.rare.isdisjoint(words):
            full = self.full.best(Counter(words))
            if full[1] >= FULL_THRESHOLD:
                return lines, full, True
        return lines, whole, False


def term_frequencies(files: DataFrame, text_col: str) -> tuple[dict[str, int], int]:
    """In how many files each template term occurs, and how many there are."""
    known = sorted(vocabulary(TEMPLATES) | vocabulary(full_texts()))
    word = F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*")
    held = F.array_intersect(
        F.regexp_extract_all(F.lower(F.col(text_col)), word, F.lit(0)), F.lit(known)
    )
    counts = files.select(F.explode(held).alias("term")).groupBy("term").count().collect()
    return {r["term"]: r["count"] for r in counts}, files.count()


FINDING = "array<struct<licence:string,score:double,start:bigint,end:bigint>>"


def scan_files(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, path, lines, licence, score, is_licence_file): matching headers,
    and the file's own licence, from a full text, its best header or the whole."""
    frequencies, total = term_frequencies(files, text_col)
    texts = full_texts()
    kinds = pa.list_(pa.struct([("licence", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(frequencies, total, texts)
        names = ("licence", "score", "start", "end")
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch["text"]]
            rows = [[dict(zip(names, line, strict=True)) for line in lines] for lines, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["path"], pa.array(rows, kinds),
                 pa.array([w[0] for _, w, _ in found], pa.string()), pa.array([w[1] for _, w, _ in found], pa.float64()),
                 pa.array([f for _, _, f in found], pa.bool_())],
                names=["doc_id", "path", "lines", "whole", "whole_score", "full"],
            )

    rows = files.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(path_col), F.lit("")).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).mapInArrow(run, f"doc_id long, path string, lines {FINDING}, whole string, whole_score double, full boolean")
    named = F.col("path").rlike(_LICENCE_NAME)
    all_found = F.concat(
        F.transform(F.when(F.col("full"), F.slice("lines", 1, 0)).otherwise(F.col("lines")), lambda x: F.struct((-x["score"]).alias("s"), x["licence"].alias("licence"))),
        F.when(F.col("whole_score") >= FILE_THRESHOLD, F.array(F.struct((-F.col("whole_score")).alias("s"), F.col("whole").alias("licence")))).otherwise(
            F.array().cast("array<struct<s:double,licence:string>>")
        ),
    )
    best = F.try_element_at(F.array_sort(all_found), F.lit(1))
    return rows.withColumn("best", best).select(
        "doc_id",
        "path",
        "lines",
        F.col("best.licence").alias("licence"),
        (-F.col("best.s")).alias("score"),
        (F.col("best").isNotNull() & (named | (F.col("whole_score") >= FILE_THRESHOLD))).alias("is_licence_file"),
    )


def directory(path: Column) -> Column:
    """The path up to its last slash; "" for the root."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """A directory and all above it as (depth, dir), down to the root."""
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")),
    )


def inherit(scanned: DataFrame) -> DataFrame:
    """(doc_id, path, licence, score, origin, origin_dir): origin is own,
    inherited or none."""
    scanned = materialize(scanned.withColumn("dir", directory(F.col("path"))))
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("licence")))
    licensed = scanned.where("is_licence_file").groupBy(F.col("dir").alias("above")).agg(best.alias("b"))
    folders = scanned.groupBy("dir").agg(F.count(F.lit(1)).alias("n")).select("dir", F.explode(ancestors(F.col("dir"))).alias("a"))
    nearest = (
        folders.select("dir", "a.depth", "a.above")
        .join(licensed, "above")
        .groupBy("dir")
        .agg(F.max_by(F.struct("above", "b.licence", "b.s"), "depth").alias("from"))
    )
    own = F.col("licence").isNotNull()
    return scanned.join(nearest, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("licence", "from.licence").alias("licence"),
        F.coalesce("score", -F.col("from.s")).alias("score"),
        F.when(own, "own").when(F.col("from").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.col("dir")).otherwise(F.col("from.above")).alias("origin_dir"),
    )


def licence_scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    return inherit(scan_files(files, path_col, text_col, id_col))
