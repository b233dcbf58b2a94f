"""Byte-level BPE token ids of whole texts, fast.

A GPT-style byte-level pre-tokenizer never lets a token cross a point where a
space follows or precedes a non-space character, so a text can be cut before
such spaces and the cuts encoded one by one with the same result. Cuts repeat
a lot (they are mostly words), so a worker remembers their ids; a new cut is
split into the pre-tokenizer's units, and a new unit goes to the tokenizers
library's own BPE model. Two kinds of text are encoded whole by the library:
those where a space stands between two other white-space characters (the run
is one unit there), and those that contain a special token's string.
"""

from __future__ import annotations

import re
from functools import lru_cache

import regex

#: Distinct cuts, and units, a worker remembers before it starts anew.
REMEMBERED = 500_000
# a space between two other white-space characters; it starts with the space, which is quick to look for
_INSIDE_RUN = re.compile(r" \s(?<=\s \s)")
# The byte-level pre-tokenizer's units.
_UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_MARKS = frozenset(".,;:!?")
# The bytes that byte-level vocabularies write as themselves.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in a byte-level vocabulary: the
    plain bytes as themselves, the others from U+0100 on."""
    other = [b for b in range(256) if b not in _PLAIN]
    return {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(other)}


class Remembered(dict):
    """Looks up what it knows and works out the rest, forgetting everything
    once ``REMEMBERED`` keys are held."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[key] = self.work(key)
        return found


class CachedEncoder:
    """``ids(text)`` gives the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.units = Remembered(self.unit)
        self.cuts = Remembered(self.cut)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def unit(self, unit: str) -> bytes:
        letters = unit.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.written[t.id] for t in self.model.tokenize(letters)])

    def cut(self, cut: str) -> bytes:
        # most new cuts are one plain word, maybe with a mark behind it
        word = cut[1:] if cut[:1] == " " else cut
        if word.isascii():
            if word.isalpha():
                return self.units[cut]
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self.units[cut[:-1]] + self.units[cut[-1]]
        return b"".join(map(self.units.__getitem__, _UNITS.findall(cut)))

    def ids(self, text: str) -> bytes:
        if _INSIDE_RUN.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        # every cut but the first starts with its space
        cuts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else re.split("(?= )", text)
        return b"".join(map(self.cuts.__getitem__, cuts))


@lru_cache(maxsize=1)
def encoder(path: str) -> CachedEncoder:
    """One per worker process, which serves many tasks."""
    return CachedEncoder(path)
