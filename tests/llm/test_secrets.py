import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from urllib.parse import quote

import pytest

from stockflow.llm import secrets
from stockflow.llm.queries import QUERIES

HIDDEN = "password=abcdefghijkl12"


def plain_spans(text):
    """The base spans straight from the contract's patterns."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_query_equals_brute_force(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op9_secret_scan"](spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = plain_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in want) for x in secrets.KINDS)
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


@pytest.mark.parametrize(
    "wrap",
    [
        lambda t: base64.b64encode(t.encode()).decode(),
        lambda t: base64.b64encode(base64.b64encode(t.encode())).decode(),
        lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode(),
        lambda t: "".join(f"%{b:02x}" for b in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
        lambda t: quote(base64.b64encode(t.encode()).decode() + "=", safe=""),
    ],
)
def test_layers_are_unwrapped_and_mapped_back(wrap):
    inside = wrap(HIDDEN)
    base, spans = secrets.scan_text(f"see é {inside} here")
    assert set(base) <= set(spans)
    found = [s for s in spans if s[0] == "assign"]
    assert found and all(6 <= s < e <= 6 + len(inside) for _, s, e in found)


def test_escapes_map_letter_by_letter():
    text = "x token%3Dabcdefghijkl y"
    assert secrets.scan_text(text)[1] == [("assign", 2, 22)]


VALUE = "hunter2hunter2x"


@pytest.mark.parametrize(
    ("before", "secret"),
    [
        ("see ", 'token = "{p}"'),
        ("é x ", '"password": "{u}"'),
        ("a 50%20off b ", 'tok\\u0065n = "{v}"'),
        ("a ", "api%5Fkey : '{v}'"),
        ("a token: ", "password%3A {v}"),
        ("%41 \\x41 ", "secret%20%3D%20{x}"),
    ],
)
def test_escapes_beside_spaces(before, secret):
    put = {
        "v": VALUE,
        "p": "".join(f"%{b:02x}" for b in VALUE.encode()),
        "u": "".join(f"\\u{ord(c):04x}" for c in VALUE),
        "x": "".join(f"\\x{ord(c):02x}" for c in VALUE),
    }
    hidden = secret.format(**put)
    base, spans = secrets.scan_text(f"{before}{hidden} and more")
    start = len(before) + hidden.startswith('"')
    want = ("assign", start, len(before) + len(hidden.rstrip("\"'")))
    assert want in spans and want not in base


def b64(raw):
    return base64.b64encode(raw).decode()


NOISE = bytes(range(128, 256)) * 2
LINES = "\n".join(f"{i} {hashlib.sha256(str(i).encode()).hexdigest()[:9]}" for i in range(60)).encode()
ENCODED = {
    "behind_path": f"/some/path/{b64(HIDDEN.encode())}",
    **{f"behind_{n}": "id_" + "x" * n + b64(HIDDEN.encode()) for n in range(4)},
    "mixed_bytes": b64(b"\0\x07" + HIDDEN.encode() + b"\0" + NOISE),
    "mime_lines": base64.encodebytes(b"a" * 50 + b" " + HIDDEN.encode()).decode().strip(),
    "crlf": b64(b"a" * 50 + b" " + HIDDEN.encode() + b" " + b"b" * 90).replace("YWFh", "YWFh\r\n  "),
    "written_breaks": b64(b"a " + HIDDEN.encode() + b" b").replace("c3N3", "c3\\nN3"),
    "gzip_lines": base64.encodebytes(gzip.compress(LINES + HIDDEN.encode(), mtime=0)).decode().strip(),
    "xz_lines": base64.encodebytes(lzma.compress(LINES + HIDDEN.encode())).decode().strip(),
    "behind_other_bytes": "/a/" + b64(b"x^\x1f\x8b\x08" + gzip.compress(HIDDEN.encode(), mtime=0) + NOISE),
    "gzip_members": b64(gzip.compress(b"one", mtime=0) + gzip.compress(HIDDEN.encode(), mtime=0)),
    "over_members": b64(gzip.compress(HIDDEN[:12].encode(), mtime=0) + gzip.compress(HIDDEN[12:].encode(), mtime=0)),
    "bzip2_streams": b64(bz2.compress(b"one") + bz2.compress(HIDDEN.encode())),
    "xz_streams": b64(lzma.compress(b"one") + lzma.compress(HIDDEN.encode())),
    "gzip_in_gzip": b64(gzip.compress(gzip.compress(HIDDEN.encode(), mtime=0), mtime=0)),
    "xz_in_mixed_in_bzip2": b64(bz2.compress(NOISE + lzma.compress(HIDDEN.encode()) + NOISE)),
    "cut_short": b64(gzip.compress(zlib.compress(HIDDEN.encode()) + LINES, mtime=0)[:-20]),
}


@pytest.mark.parametrize("name", ENCODED)
def test_any_place_and_any_bytes(name):
    inside = ENCODED[name]
    base, spans = secrets.scan_text(f"see é: {inside} here\nand more")
    found = [s for s in spans if s[0] == "assign"]
    assert not base and found and all(7 <= s < e <= 7 + len(inside) for _, s, e in found)


def test_compressed_data_spans_only_itself():
    inside = b64(gzip.compress(HIDDEN.encode(), mtime=0) + b"tail of other bytes")
    start, end = next(s[1:] for s in secrets.scan_text(inside)[1])
    assert (start, end) == (0, len(inside) - 4 * (len(b"tail of other bytes") // 3))


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_data_longer_than_windows(monkeypatch, pack):
    monkeypatch.setattr(secrets, "WINDOW", 4096)
    monkeypatch.setattr(secrets, "OVERLAP", 64)
    monkeypatch.setattr(secrets, "PIECE", 512)
    deep = pack(LINES * 9 + HIDDEN.encode() + b"\n" + LINES * 9)
    inside = b64(pack(NOISE * 40 + random.Random(4).randbytes(9000) + deep + LINES * 30))
    assert [s for s in secrets.scan_text(inside)[1] if s[0] == "assign"]


@pytest.mark.parametrize(
    "chained",
    [
        lambda n, c: "%" + "25" * n + f"{ord(c):02x}",
        lambda n, c: "\\" + "u005c" * n + f"u{ord(c):04x}",
        lambda n, c: "\\" + "x5C" * n + f"x{ord(c):02x}",
        lambda n, c: "\\" + "u{5c}" * n + f"u{{{ord(c):x}}}",
    ],
)
def test_nested_escapes_are_followed_in_place(monkeypatch, chained):
    read = []
    scan = secrets.scan_layer
    monkeypatch.setattr(secrets, "scan_layer", lambda text, every=False: read.append(len(text)) or scan(text, every))
    letters = {}
    for n in (0, 1, 2, 50, 100, 200):
        hidden = "".join(chained(n if i % 3 else 1, c) for i, c in enumerate("password=")) + VALUE
        read.clear()
        base, spans = secrets.scan_text(f"é {hidden} x")
        assert ("assign", 2, 2 + len(hidden)) in spans and not [s for s in base if s[0] == "assign"]
        letters[n] = sum(read)
    # the letters read grow with the text, not with its square
    assert letters[200] < 2.5 * letters[100] < 6.5 * letters[50]


def test_mixed_depths_of_utf8_escapes():
    text = "%25E2%2582%AC token%25253D" + VALUE
    assert [s for s in secrets.scan_text(text)[1] if s[0] == "assign"] == [("assign", 14, len(text))]
    layers = [layer.text for layer in secrets._decoded(secrets.Layer(text, lambda s, e: (s, e)))]
    assert layers[0] == "\u20ac token=" + VALUE


def test_edge_rows_and_masking(spark, edge_docs, no_docs):
    assert secrets.find_secrets(edge_docs).count() == edge_docs.count()
    assert secrets.find_secrets(no_docs).count() == 0
    assert secrets.mask_secrets(edge_docs).columns == edge_docs.columns
    row = spark.createDataFrame([(1, f"a {HIDDEN} b", 27)], "doc_id long, text string, n_chars long")
    got = secrets.mask_secrets(row).first()
    assert (got.text, got.n_chars) == ("a [SECRET] b", 12)
