"""Quality rules by line-first cleaning.

Every line of a text is judged on its own; lines that fail a rule are removed,
and then the document is rejected if too much of it is gone. A line fails by

* *punctuation*: more than ``MARKS`` per cent as many runs of ``#*$%&<>`` and of
  repeated ``!?`` as words; or fewer than ``SHORT_LINE`` words with no mark that
  ends a sentence or clause at their end;
* *navigation*: at least two separators that stand alone (``|``, bullets,
  angle marks), more than ``SEPARATORS`` per cent of the words; or nothing but
  menu words;
* *boilerplate*: at most ``NOTICE_WORDS`` words with a phrase of a notice; or
  filler in which more than ``STUTTER`` per cent of the words repeat the word
  before them.

The first rule in this order that a line fails is the one it counts for. Lines
without a word are kept as they are and count for nothing. A document's loss is
the share of its word letters in removed lines; above ``max_loss`` per cent the
document is rejected. The base rules (too few words, words in repeated windows
of three) look at the text as it came.

Defined cases: null text has no words and is rejected by the base rule; a text
of any length is read whole, with memory in proportion to it; rows repeated are
judged each; a null id stays null; an empty table gives an empty result; other
columns are left behind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockflow.llm.common import id_text

LEAST_WORDS = 50
MOST_REPEATED = 50
MAX_LOSS = 40
MARKS = 30
SHORT_LINE = 5
SEPARATORS = 15
NOTICE_WORDS = 25
STUTTER = 30
#: Words from which repeated windows are told by numbers instead of by the words themselves.
LONG_TEXT = 100_000
RULES = ("punctuation", "navigation", "boilerplate")

# Separators between the entries of a menu, the entries of common menus, and phrases of notices.
NAVIGATION_MARKS = ("|", ">", "/", "\\", "»", "›", "•", "·", "→", "::")
MENU_WORDS = (
    "home", "menu", "next", "previous", "prev", "login", "logout", "register", "search", "contact", "about", "help",
    "sitemap", "back", "top", "share", "print", "faq", "news", "blog", "archive", "archives", "categories", "tags",
    "rss", "more",
)
NOTICES = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "terms and conditions",
    "uses cookies", "use of cookies", "accept cookies", "enable javascript", "javascript is disabled", "lorem ipsum",
    "click here", "read more", "sign up", "log in", "subscribe to", "follow us", "share this", "skip to content",
    "back to top", "powered by", "add to cart", "leave a comment", "page not found",
)

_MARKS = re.compile(rb"[#*$%&<>]+|[!?]{2,}")
_ENDED = re.compile("[.!?:;,…][\"'”’»)\\]]*[\x20\x09-\x0d]*$")
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_NOTICE = re.compile("|".join(map(re.escape, NOTICES)).encode())
_SEPARATORS = frozenset(m.encode() for m in NAVIGATION_MARKS)
_MENU = frozenset(w.encode() for w in MENU_WORDS)
_EDGES = b".,:;!?"


class Base(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def letters(words: list[bytes]) -> int:
    """Code points of the words."""
    return len(b"".join(words).decode())


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur twice or more."""
    if len(words) < 4:
        return 0
    if len(words) > LONG_TEXT:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        windows = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        inside = np.zeros(len(words), dtype=bool)
        again = np.flatnonzero(windows[2][windows[1]] > 1)
        for k in range(3):
            inside[again + k] = True
        return int(inside.sum())
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, end = 0, 0
    for k, window in enumerate(windows):
        if counts[window] > 1:
            total += k + 3 - max(end, k)
            end = k + 3
    return total


def base_counts(text: str) -> Base:
    raw = text.encode()
    words = raw.split()  # bytes are split at the six ASCII white-space characters only
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = len(lines) - len(set(lines))
    return Base(len(words), letters(words), len(_SYMBOLS.findall(raw)), repeats, repeated_words(words))


def failed_rule(line: str) -> int | None:
    """The number of the first of ``RULES`` that the line fails, or None."""
    raw = line.encode()
    words = raw.split()
    n = len(words)
    if 100 * len(_MARKS.findall(raw)) > MARKS * n or (n < SHORT_LINE and not _ENDED.search(line)):
        return 0
    separators = sum(w in _SEPARATORS for w in words)
    if separators >= 2 and 100 * separators > SEPARATORS * n:
        return 1
    low = raw.lower()  # A-Z only
    if all(w.strip(_EDGES) in _MENU for w in low.split()):
        return 1
    if n <= NOTICE_WORDS and _NOTICE.search(low):
        return 2
    if 100 * sum(map(bytes.__eq__, words, words[1:])) > STUTTER * n:
        return 2
    return None


def clean_lines(text: str) -> tuple[str, list[int]]:
    """(text without the failing lines, word letters lost to each rule)."""
    kept, lost = [], [0] * len(RULES)
    for line in text.split("\n"):
        words = line.encode().split()
        rule = failed_rule(line) if words else None
        if rule is None:
            kept.append(line)
        else:
            lost[rule] += letters(words)
    return "\n".join(kept), lost


def judge(
    docs: DataFrame, max_loss: int = MAX_LOSS, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, the word
    letters lost to each rule (lost_*), kept, and with ``with_text`` the
    cleaned text."""
    counts = [*Base._fields, *(f"lost_{r}" for r in RULES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, failed, kept, cleaned = [], [], [], []
            for value in batch["text"]:
                text = value.as_py()
                base = base_counts(text)
                left, lost = clean_lines(text)
                rows.append((*base, *lost))
                failed.append(base.failed)
                kept.append(not base.failed and 100 * sum(lost) <= max_loss * base.word_chars)
                cleaned.append(left)
            columns = list(zip(*rows, strict=True)) or [()] * len(counts)
            arrays = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns), pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())]
            names = ["doc_id", *counts, "base_failed", "kept"]
            if with_text:
                arrays.append(pa.array(cleaned, pa.string()))
                names.append("cleaned")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in counts), "base_failed boolean", "kept boolean"])
    return id_text(docs, id_col, text_col).mapInArrow(run, schema + (", cleaned string" if with_text else ""))


def keep_good(docs: DataFrame, max_loss: int = MAX_LOSS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the documents that stay, with their cleaned texts."""
    return judge(docs, max_loss, True, id_col, text_col).where("kept").selectExpr("doc_id", "cleaned AS text")
