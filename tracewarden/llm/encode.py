"""Encoding with the tokenizers library, remembering fragments.

A fragment is a stretch of text whose ids don't depend on its surroundings, so the library encodes each one once for as long as it
is remembered. Two kinds of tokenizer files are known: those that drop white space (a fragment is a word), and
byte-level ones whose pattern lets one space lead a word. A byte-level text with white space beyond ASCII, or any
text with a special token's string, goes to the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

from tracewarden.llm.words import Memo

_SPACES = rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
#: A word with at most one leading space; white space up to the last of it; the last of it.
_BYTE_LEVEL = re.compile(rb" ?[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+(?![^\x20\x09-\x0d])|[\x20\x09-\x0d]")
_LETTERS_THEN_MARKS = re.compile(rb"( ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!#$%&*,.:;?|]+)")
#: Letters of Latin-1 with at most one leading space: one piece for the model, whatever the pattern and normaliser.
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Fragments that are remembered: encoding one anew costs more than hashing a word, and a process meets more than ``MEMO_ENTRIES``.
FRAGMENTS = 1_500_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return [chr(0x100 + others.index(b)) if b in others else chr(b) for b in range(256)]


class Encoder:
    """``encoder(text)``: the ids of a whole text (bytes) as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path) as f:
            spec = json.load(f)
        byte_level = spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["normalizer"]
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.spaces = re.compile(_SPACES if byte_level else rb"(?!)")
        self.lower = any(n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        self.letter_of = dict(enumerate(byte_letters()))
        # The bare model, for fragments that normaliser and pattern leave in one piece.
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "decoder": None, "added_tokens": [], "truncation": None, "padding": None}
        self.model = Tokenizer.from_str(json.dumps(bare))
        self.split = _BYTE_LEVEL.findall if byte_level else bytes.split
        self.memo = Memo(self._fragment, FRAGMENTS)

    def _library(self, text: bytes) -> bytes:
        ids = array("I", self.library.encode(text.decode(), add_special_tokens=False).ids)
        return ids.tobytes()

    def _fragment(self, fragment: bytes) -> bytes:
        if _LETTERS.fullmatch(fragment):
            plain = fragment.decode().lower().encode() if self.lower else fragment
            return array("I", self.model.encode(plain.decode("latin-1").translate(self.letter_of)).ids).tobytes()
        parts = _LETTERS_THEN_MARKS.fullmatch(fragment)
        if parts:  # letters and marks are never in one token
            return self.memo[parts[1]] + self.memo[parts[2]]
        return self._library(fragment)

    def __call__(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        # Where the library would lower A-Z anyway, their forms share a fragment.
        plain = text.lower() if self.lower else text
        if any(t in plain for t in self.special) or not text.isascii() and self.spaces.search(text):
            return self._library(text)
        return b"".join(map(self.memo.__getitem__, self.split(plain)))


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per process and file."""
    return Encoder(path)
