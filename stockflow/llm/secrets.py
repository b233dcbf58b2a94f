"""Secret scan with a recursive decoding worklist.

Every text is scanned for three kinds of secrets. Then a worklist unwraps what
is encoded in it: percent escapes, \\u and \\x escapes (each decoded over the
whole text, so that a key and its value are found together when only one of
them is escaped; an escaped escape sign is followed to its end at once),
base64, and compressed data (gzip, zlib, bzip2, xz) inside
base64. Each decoded layer is scanned
again and searched for further encodings, until nothing new turns up. A layer
whose content was seen before in the document is not entered again, so chains
that decode into themselves end. Findings in a layer are mapped back to the
place in the original text that they were decoded from: escapes letter by
letter, base64 by its groups of four letters, compressed data as a whole.

Base64 is decoded over line breaks and from each of its first four letters on,
since it may begin anywhere in a run of its letters. The bytes may be of any
kind: compressed data is found by its magic numbers wherever it begins, also
inside other compressed data, and one behind the other.

Compressed data is expanded in windows of ``WINDOW`` letters that overlap by
``OVERLAP``, so a small input that expands without bound never sits in memory
whole, and no part of it is left out; only a secret longer than the overlap
can be cut at a window's edge (it is still found as one of its halves), and
encoded text that crosses an edge is decoded as its parts.

Defined cases: null text is empty text and has no spans; positions are code
points, ends exclusive; overlapping finds of different kinds are all kept;
repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones are the failing matches
LEAST = {"assign": 12, "access": 18}

#: Least letters of a base64 run that is tried.
BASE64_LEAST = 16
WINDOW = 1 << 20
OVERLAP = 1 << 12

#: Bytes of compressed data read at a time.
PIECE = 1 << 16

_LINE = r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*"  # also written as an escape
_LINE_BREAK = re.compile(_LINE)
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{%d,}(?:%s[A-Za-z0-9+/_-]+)*|[A-Za-z0-9+/_-]+(?:%s[A-Za-z0-9+/_-]+)+)={0,2}"
    % (BASE64_LEAST, _LINE, _LINE)
)
_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
_MAGIC_MOST = 5  # letters of a magic number that the end of a piece can hold
# An escape of the escape sign itself (%25, \\u005c) is followed to the end of
# its chain at once, in place: %252541 is A, and not first %2541 and then %41,
# each a layer as long as the text.
_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_PERCENT_RUN = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\(?:u\{0{0,4}5[Cc]\}|u005[Cc]|x5[Cc])*"
    r"(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2}))"
)
_URLSAFE = str.maketrans("-_", "+/")

Span = tuple[str, int, int]


def scan_layer(text: str, every: bool = False) -> list[Span]:
    """The kinds' spans in one text, leftmost and non-overlapping per kind. With
    ``every``, a key whose value is too short doesn't hide one inside it, as in
    ``token: password: ...``."""
    found: list[Span] = []
    low = text.lower()
    if not any(w in low for w in _ASSIGN_WORDS):
        pass
    elif every:
        m = _ASSIGN.search(text)
        while m:
            enough = len(m[2]) >= LEAST["assign"]
            found += [("assign", *m.span())] * enough
            m = _ASSIGN.search(text, m.end() if enough else m.start() + 1)
    else:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


class Layer:
    """A text and where its letters came from. ``root(start, end)`` maps a
    stretch of the text that the layer's escapes were decoded from to the
    original; the decoded letters are listed in order by their place here
    (``at``) and their escape's there (``starts``, ``ends``). All the others
    follow letter by letter."""

    def __init__(self, text: str, root: Callable[[int, int], tuple[int, int]], at=(), starts=(), ends=()):
        self.text, self.root, self.at, self.starts, self.ends = text, root, at, starts, ends

    def inner(self, start: int, end: int) -> tuple[int, int]:
        """The stretch of the root's text that a stretch here came from."""
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        first, last = start, end
        if i >= 0:
            first = self.starts[i] if self.at[i] == start else self.ends[i] + start - self.at[i] - 1
        if j >= 0:
            last = self.ends[j] + end - self.at[j] - 1
        return first, last

    def place(self, start: int, end: int) -> tuple[int, int]:
        return self.root(*self.inner(start, end))


def _substitute(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with each match replaced by ``decode(match)``, a list of
    (letter, from, to): what the letter was decoded from in the layer. None if
    nothing matches."""
    text = layer.text
    letters: list[str] = []
    at: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    known = size = done = 0  # decoded letters of the layer passed, letters put, letters of the layer read

    def keep(upto: int) -> None:
        nonlocal known, size
        while known < len(layer.at) and layer.at[known] < upto:
            if layer.at[known] >= done:
                at.append(size + layer.at[known] - done)
                starts.append(layer.starts[known])
                ends.append(layer.ends[known])
            known += 1
        letters.append(text[done:upto])
        size += upto - done

    for m in pattern.finditer(text):
        keep(m.start())
        for letter, start, end in decode(m):
            s, e = layer.inner(start, end)
            letters.append(letter)
            at.append(size)
            starts.append(s)
            ends.append(e)
            size += 1
        done = m.end()
    if not at:
        return None
    keep(len(text))
    return Layer("".join(letters), layer.root, at, starts, ends)


def _percent_letters(m: re.Match) -> list[tuple[str, int, int]]:
    """A run of percent escapes as UTF-8; each letter from its own escapes."""
    escapes = [*_PERCENT.finditer(m.string, *m.span())]
    raw = bytes.fromhex("".join([e[1] for e in escapes]))
    out, at = [], 0
    for letter in raw.decode("utf-8", "surrogateescape"):
        n = len(letter.encode("utf-8", "surrogateescape"))
        shown = "\ufffd" if "\ud800" <= letter <= "\udfff" else letter
        out.append((shown, escapes[at].start(), escapes[at + n - 1].end()))
        at += n
    return out


def _escape_letter(m: re.Match) -> list[tuple[str, int, int]]:
    code = int(m[1] or m[2] or m[3], 16)
    letter = "\ufffd" if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF else chr(code)
    return [(letter, m.start(), m.end())]


class _Member:
    """Finds compressed data in bytes that come piece by piece, and expands it.
    Between compressed data the bytes are searched for its magic numbers. What
    only looked like compressed data, or is cut short, is searched again from
    its second byte on, as long as it is no more than ``WINDOW`` bytes."""

    def __init__(self):
        self.box = None
        self.tail = self.held = b""
        self.kept = ""
        self.ended = False  # compressed data has just ended; what follows at once goes on with its text
        self.left = 0  # how many bytes followed from where the data began

    def step(self, data: memoryview) -> tuple[bytes, memoryview | None, bool]:
        """(expanded bytes, what is left to read or None, whether new
        compressed data begins there)."""
        if self.box is None:
            if self.tail:
                data, self.tail = memoryview(self.tail + bytes(data)), b""
            m = _MAGIC.search(data)
            if m is None:
                self.tail, self.ended = bytes(data[-_MAGIC_MOST:]), False
                return b"", None, False
            if m[0][:1] == b"B":
                self.box = bz2.BZ2Decompressor()
            else:
                self.box = lzma.LZMADecompressor() if m[0][:1] == b"\xfd" else zlib.decompressobj(47)
            self.held = b""
            data = data[m.start() :]
            if m.start() or not self.ended:
                self.kept, self.left = "", len(data)
                return b"", data, True
        more = getattr(self.box, "needs_input", True)
        piece = data[:PIECE] if more else data[:0]
        try:
            out = self.box.decompress(piece, WINDOW)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, MemoryError):
            self.box, self.ended = None, False
            if self.held is None:
                return b"", data, False
            again = memoryview(self.held + bytes(data)) if self.held else data
            return b"", again[1:], False
        over = self.box.eof
        unread = self.box.unused_data if over else getattr(self.box, "unconsumed_tail", b"")
        if len(unread) > len(piece):  # the box had bytes of earlier pieces
            rest = memoryview(unread + bytes(data[len(piece) :]))
        else:
            rest = data[len(piece) - len(unread) :]
        if over:
            self.box, self.ended = None, True
            return out, rest if len(rest) else None, False
        if self.held is not None:
            self.held += piece[: len(piece) - len(unread)]
            if len(self.held) > WINDOW:
                self.held = None
        waits = not len(rest) and getattr(self.box, "needs_input", len(out) < WINDOW)
        return out, None if waits else rest, False

    def again(self) -> memoryview | None:
        """At the end of the bytes: what to search again of data cut short."""
        cut = self.box is not None and bool(self.held)
        self.box, self.ended, self.tail = None, False, b""
        return memoryview(self.held)[1:] if cut else None


def _extents(raw: bytes) -> dict[int, int]:
    """Where each stretch of compressed data in ``raw`` begins and ends."""
    member, data, ends = _Member(), memoryview(raw), {}
    while data is not None:
        _, data, _ = member.step(data)
        if member.ended:
            ends[len(raw) - member.left] = len(raw) - (0 if data is None else len(data))
        if data is None:
            data = member.again()
    return ends


def _expanded(raw: bytes) -> Iterator[tuple[int, str]]:
    """Windows of the text of all compressed data in ``raw``, also of that
    inside other compressed data, each with the place in ``raw`` where its data
    begins. The inner data is read while the outer one is expanded, one window
    of each at a time."""
    inside = [_Member()]
    work = [(0, memoryview(raw))]

    def cut_short(depth: int) -> list[tuple[int, memoryview]]:
        return [(d, data) for d in range(depth, len(inside)) if (data := inside[d].again()) is not None]

    while work or (work := cut_short(0)):
        depth, data = work.pop()
        member = inside[depth]
        out, rest, begins = member.step(data)
        if rest is not None:
            work.append((depth, rest))
        if begins:
            work += cut_short(depth + 1)
        if out:
            text = member.kept + out.decode("latin-1")
            yield len(raw) - inside[0].left, text
            member.kept = text[-OVERLAP:]
            if len(inside) == depth + 1:
                inside.append(_Member())
            work.append((depth + 1, memoryview(out)))


def _base64_layers(layer: Layer, run: re.Match) -> Iterator[Layer]:
    """The run's lines joined and decoded from each of its first four letters
    on, as encoded data can begin anywhere behind a path or a name. Bytes are
    letters here (Latin-1): secrets and encodings are ASCII, so they are found
    among any other bytes."""
    begin, end = run.span()
    lines, at, starts, size = [], [], [], 0
    for gap in [*_LINE_BREAK.finditer(layer.text, begin, end), None]:
        lines.append(layer.text[begin : gap.start() if gap else end])
        at.append(size)
        starts.append(begin)
        size += len(lines[-1])
        begin = gap.end() if gap else end
    joined = "".join(lines).translate(_URLSAFE)
    size = len(joined.rstrip("="))

    def where(i: int) -> int:
        j = bisect_right(at, i) - 1
        return starts[j] + i - at[j]

    for skip in range(4):
        n = size - skip
        n -= n % 4 == 1
        if n < 2:
            continue
        raw = base64.b64decode(joined[skip : skip + n] + "=" * (-n % 4))

        def root(s: int, e: int, skip=skip) -> tuple[int, int]:
            last = min(len(joined), skip + (e + 2) // 3 * 4) - 1
            return layer.place(where(skip + s // 3 * 4), where(last) + 1)

        yield Layer(raw.decode("latin-1"), root)
        if _MAGIC.search(raw):
            ends = _extents(raw)
            for start, window in _expanded(raw):
                whole = root(start, ends.get(start, len(raw)))
                yield Layer(window, lambda s, e, whole=whole: whole)


def _decoded(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside a layer."""
    text = layer.text
    if "%" in text and (plain := _substitute(layer, _PERCENT_RUN, _percent_letters)):
        yield plain
    if "\\" in text and (plain := _substitute(layer, _ESCAPE, _escape_letter)):
        yield plain
    for m in _BASE64.finditer(text):
        if m.end() - m.start() >= BASE64_LEAST:
            yield from _base64_layers(layer, m)


def scan_text(text: str) -> tuple[list[Span], list[Span]]:
    """(spans in the text itself, those and the spans of all its layers),
    each sorted by start, kind and end."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(scan_layer(text), key=order)
    found = set(base)
    seen = {hash(text)}
    work = [_decoded(Layer(text, lambda s, e: (s, e)))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text or (mark := hash((layer.text, layer.place(0, 1)[0]))) in seen:
            continue
        seen.add(mark)
        found.update((kind, *layer.place(s, e)) for kind, s, e in scan_layer(layer.text, every=True))
        work.append(_decoded(layer))
    return base, sorted(found, key=order)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _span_dicts(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): the spans in the text itself, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array([_span_dicts(f[i]) for f in found], _SPANS) for i in (0, 1)]],
                names=["doc_id", "base", "spans"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, base {SPANS}, spans {SPANS}")


def masked(text: str, spans: list[Span], mask: str) -> str:
    """The text with the union of the spans replaced, one mask per stretch."""
    out, at = [], 0
    for start, end in sorted((s, e) for _, s, e in spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The documents with their secrets masked in the text, and the length
    column (if there) corrected for those; all others stay as they are."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index(text_col)).to_pylist()
            found = [scan_text(t)[1] if t else [] for t in texts]
            new = [masked(t, f, mask) if f else t for t, f in zip(texts, found, strict=True)]
            arrays = list(batch.columns)
            i = columns.index(text_col)
            arrays[i] = pa.array(new, arrays[i].type)
            if length_col in columns:
                i = columns.index(length_col)
                old = arrays[i].to_pylist()
                arrays[i] = pa.array([len(t) if f else n for t, f, n in zip(new, found, old, strict=True)], arrays[i].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
