"""SentencePiece ids against the reference library on whole texts, for the public BPE model and a small unigram one."""

import random
import struct
import zlib
from array import array

import pytest
import sentencepiece

from conftest import EDGE_ROWS
from stockflow.llm import pieces
from stockflow.llm.queries import QUERIES

ODD = [
    "", " ", "  two  spaces ", "a\nb\n\nc", "\n", "tab\there", "é 😀 ñ ß", "a▁b", "▁", " x", "x" * 500, "word " * 300,
    "Ünïcödé", "\r\n", "mixed 漢字 text", "0123456789 !?", " lead", "trail ", "é", "\x00\x01", "a b▁ c",
]


def ids_of(blob):
    return array("I", blob).tolist()


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """A small unigram model written field by field: scores set by hand, bytes as fallback."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]
    texts = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "▁abc", "▁the", "the", "t", "h", "e", "he", "▁t", "er", "r", "é"]
    rows += [(t, -1.0 - 0.37 * k - 0.011 * k * k, 1) for k, t in enumerate(texts)]
    body = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, kind)) for t, s, kind in rows)
    trainer = field(3, 1) + field(35, 1)
    normaliser = field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(body + field(2, trainer) + field(3, normaliser))
    return str(path)


def random_texts(n=300):
    pick = random.Random(8)
    parts = ["the", "abc", "ab", " ", "  ", "\n", "é", "zz", "▁", "her", ", ", "😀", "a", "c"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_ids_equal_the_reference_library_on_whole_texts(kind, piece_path, unigram_path):
    path = piece_path if kind == "bpe" else unigram_path
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    work = pieces.PieceEncoder(path)
    texts = ODD + random_texts()
    for text, (blob, parity, back) in zip(texts, work.encode(texts), strict=True):
        assert ids_of(blob) == reference.encode(text), repr(text)
        assert parity
        assert back == (reference.decode(ids_of(blob)) == text), repr(text)


def test_query_on_the_small_table(spark, sf_small, piece_path):
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    found = QUERIES["op6_sentencepiece"](spark, sf_small).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(array("I", ids).tobytes()))
        assert r.parity and r.round_trip == (reference.decode(ids) == texts[r.doc_id])


def test_decode_gives_the_texts_back(spark, piece_path):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(99, None)]
    encoded = pieces.encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), piece_path)
    verdicts = {r.doc_id: r.round_trip for r in encoded.collect()}
    for r in pieces.decode(encoded, piece_path).collect():
        want = dict(rows)[r.doc_id] or ""
        assert (r.text == want) == verdicts[r.doc_id], (r, want)
    assert not verdicts[ODD.index("a▁b")] and verdicts[ODD.index("  two  spaces ")] and verdicts[99]
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert pieces.decode(nothing, piece_path).first().text is None


def test_defined_cases(spark, edge_docs, no_docs, piece_path):
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    assert pieces.encode(no_docs, piece_path).count() == 0
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = sorted(((r.doc_id, ids_of(r.ids)) for r in pieces.encode(edge_docs, piece_path).collect()), key=key)
    assert found == sorted(((r[0], reference.encode(r[1] or "")) for r in EDGE_ROWS), key=key)
