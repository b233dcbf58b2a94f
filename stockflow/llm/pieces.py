"""SentencePiece encoding and decoding on the tokenizers library.

``read_model`` parses the model protobuf (pieces, scores, types, and the
trainer's and normaliser's settings) without the sentencepiece library.
``rebuild`` makes a tokenizers ``Tokenizer`` from it: the precompiled character
map if there is one, the dummy prefix and the metaspace marker as normaliser,
a Unigram model with the pieces' scores or a BPE model with merges in the order
of the merged pieces' scores, byte fallback, and the reverse as decoder.

Texts are encoded in batches: no piece of such a model reaches across a place
where a metaspace follows another letter, or across a line end if no longer
piece holds one, so texts are cut there (``cuttable`` checks the vocabulary,
otherwise texts are encoded whole). A worker remembers the cuts' ids; the new
cuts of a batch go through the library's multithreaded ``encode_batch`` and are
verified there and then: the sentencepiece library must give the same ids
(parity) and decoding must give the cut back (round trip). Both verdicts are
part of the result.

Defined cases: null text is empty text and has no tokens; characters without a
piece become their UTF-8 bytes under byte fallback, else the unknown id; a text
that holds the metaspace itself, or spaces that the normaliser squeezes, does
not come back and has a false round-trip verdict; a very long text is cut like
any other (a model that ``cuttable`` refuses encodes it in one piece);
repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import id_text

SPACE = "▁"
# Model and piece types, and field numbers, of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_MODEL_PIECE, _MODEL_TRAINER, _MODEL_NORMALISER = 1, 2, 3
_TRAINER_TYPE, _TRAINER_BYTES, _TRAINER_SUFFIX = 3, 35, 24
_NORMALISER_MAP, _NORMALISER_DUMMY, _NORMALISER_SPACES, _NORMALISER_ESCAPE = 2, 3, 4, 5

#: Threads of a worker's encode_batch, and distinct cuts it remembers.
THREADS = 2
REMEMBERED = 500_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message, in order."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                n, at = _varint(data, at)
            else:
                n = {1: 8, 5: 4}[kind]
            value, at = data[at : at + n], at + n
        yield key >> 3, value


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix: bool = False  # the metaspace stands behind words
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        data = f.read()
    model = PieceModel()
    for number, value in message(data):
        if number == _MODEL_PIECE:
            parts = dict(message(value))
            score = array("f", parts.get(2, b"\0\0\0\0"))[0]
            model.pieces.append((parts[1].decode(), score, parts.get(3, NORMAL)))
        elif number == _MODEL_TRAINER:
            parts = dict(message(value))
            model.kind = parts.get(_TRAINER_TYPE, UNIGRAM)
            model.byte_fallback = bool(parts.get(_TRAINER_BYTES, 0))
            model.suffix = bool(parts.get(_TRAINER_SUFFIX, 0))
        elif number == _MODEL_NORMALISER:
            parts = dict(message(value))
            model.charsmap = parts.get(_NORMALISER_MAP, b"")
            model.dummy_prefix = bool(parts.get(_NORMALISER_DUMMY, 1))
            model.squeeze_spaces = bool(parts.get(_NORMALISER_SPACES, 1))
            model.escape_spaces = bool(parts.get(_NORMALISER_ESCAPE, 1))
    if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape_spaces:
        raise ValueError("only unigram and BPE models with a leading, escaped metaspace are supported")
    return model


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, in the order in which the
    merged pieces win: by score, and by the halves' places among equals."""
    number = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER, UNUSED)}
    out = []
    for piece, score, kind in model.pieces:
        if kind in (NORMAL, USER):
            for k in range(1, len(piece)):
                left, right = number.get(piece[:k]), number.get(piece[k:])
                if left is not None and right is not None:
                    out.append((-score, left, right, piece[:k], piece[k:]))
    return [(left, right) for *_, left, right in sorted(out)]


def rebuild(model: PieceModel):
    """(tokenizer for whole texts, tokenizer for normalised cuts)."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    def core() -> Tokenizer:
        if model.kind == UNIGRAM:
            scored = [(p, s) for p, s, _ in model.pieces]
            return Tokenizer(models.Unigram(scored, model.unknown, model.byte_fallback))
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        unknown = model.pieces[model.unknown][0]
        return Tokenizer(
            models.BPE(vocab, merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
        )

    whole, bare = core(), core()
    steps: list = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        # spaces only (and metaspaces at the end): other white space stays
        steps += [normalizers.Replace(Regex(rf"\A +|[ {SPACE}]+\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    whole.normalizer = normalizers.Sequence(steps)
    decode: list = [decoders.Replace(SPACE, " ")]
    if model.byte_fallback:
        decode.append(decoders.ByteFallback())
    decode.append(decoders.Fuse())
    bare.decoder = decoders.Sequence(decode)
    if model.dummy_prefix:
        decode = [*decode, decoders.Strip(" ", 1, 0)]
    whole.decoder = decoders.Sequence(decode)
    user = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER]
    if user:
        whole.add_tokens(user)
    return whole, bare


def cuttable(model: PieceModel) -> bool:
    """Whether cuts before metaspaces and around line ends change nothing."""
    inner = re.compile(f"[^{SPACE}]{SPACE}|.\n|\n.", re.S)
    plain = all(not inner.search(p) for p, _, kind in model.pieces if kind == NORMAL)
    return plain and model.byte_fallback and not any(kind == USER for *_, kind in model.pieces)


class PieceEncoder:
    """Encodes texts to ids (bytes, little-endian unsigned 32-bit) with the
    parity and round-trip verdicts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = read_model(path)
        self.whole, self.bare = rebuild(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cuts_well = cuttable(self.model)
        self.identity = not self.model.charsmap and not self.model.squeeze_spaces
        self.line = self.reference.encode("\n")
        self.known: dict[str, tuple[bytes, bool, bool]] = {}
        self.cut = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def normalised(self, text: str) -> str:
        if self.identity:
            return (SPACE if self.model.dummy_prefix and text else "") + text.replace(" ", SPACE)
        return self.whole.normalizer.normalize_str(text) if text else ""

    def _learn(self, cuts: list[str]) -> None:
        """Encode and verify new cuts, in one multithreaded batch."""
        found = self.bare.encode_batch(cuts, add_special_tokens=False)
        ids = [e.ids for e in found]
        back = self.bare.decode_batch(ids, skip_special_tokens=False)
        # after a line end the reference library adds no prefix to a cut
        spaced = [c.replace(SPACE, " ") for c in cuts]
        expected = self.reference.encode(["\n" + c for c in spaced], num_threads=1)
        n = len(self.line)
        for cut, plain, own, text, other in zip(cuts, spaced, ids, back, expected, strict=True):
            self.known[cut] = (array("I", own).tobytes(), other[n:] == own, text == plain)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        if not (self.cuts_well and self.identity):
            return self._encode_whole(texts)
        parts = [self.cut.findall(self.normalised(t)) for t in texts]
        known = self.known
        new = list({c for p in parts for c in p if c not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({c for p in parts for c in p})
        if new:
            self._learn(new)
        out = []
        for text, p in zip(texts, parts, strict=True):
            got = [known[c] for c in p]
            # a metaspace of the text itself is decoded as a space
            back = SPACE not in text and all(g[2] for g in got)
            out.append((b"".join([g[0] for g in got]), all(g[1] for g in got), back))
        return out

    def _encode_whole(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        found = self.whole.encode_batch(texts, add_special_tokens=False)
        ids = [e.ids for e in found]
        back = self.whole.decode_batch(ids, skip_special_tokens=False)
        expected = self.reference.encode(texts, num_threads=1)
        return [
            (array("I", own).tobytes(), other == own, shown == text)
            for own, shown, other, text in zip(ids, back, expected, texts, strict=True)
        ]


@lru_cache(maxsize=1)
def encoder(path: str, threads: int) -> PieceEncoder:
    """One per worker process, which serves many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    return PieceEncoder(path)


def encode(
    docs: DataFrame, model_path: str, threads: int = THREADS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids, parity, round_trip); ids are little-endian unsigned
    32-bit, as ``decode`` reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(model_path, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = work.encode(part["text"].to_pylist())
                columns = zip(*found, strict=True)
                kinds = (pa.binary(), pa.bool_(), pa.bool_())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *arrays], names=["doc_id", "ids", "parity", "round_trip"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, model_path: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, text) of ``encode``'s ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(model_path, threads)
        for batch in batches:
            raw = [array("I", b) if b is not None else array("I") for b in batch["ids"].to_pylist()]
            texts = work.whole.decode_batch([list(r) for r in raw], skip_special_tokens=False)
            shown = [t if ok else None for t, ok in zip(texts, batch["ids"].is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(shown, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, parity, round_trip)."""
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        "parity",
        "round_trip",
    )
