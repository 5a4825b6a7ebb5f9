"""BPE encoding and decoding with forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary can't be merged over, so a cut between such bytes is certain. A word is
normalised and split as the tokenizer file says, cut at all its forced boundaries, and the fragments are encoded independently: the ids of the
word are those of its fragments, one after the other. Only the last fragment of a word carries the end-of-word mark.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tracewarden.llm.encode import byte_letters
from tracewarden.llm.words import Memo, per_document, texts

#: White space as the patterns of tokenizer files mean it (Unicode White_Space).
WHITE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class ForcedBoundaryBpe:
    """A word-level BPE file (lower case, white space dropped, end-of-word mark): ``encode`` and ``decode`` whole texts."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"] or spec["decoder"]:
            raise ValueError(f"{path} is no word-level BPE file of the known kind")
        self.mark, self.vocabulary = model["end_of_word_suffix"], model["vocab"]
        self.order = {tuple(pair): k for k, pair in enumerate(model["merges"])}
        self.letters = byte_letters()
        self.pieces = regex.compile(pre[0]["pattern"]["Regex"].replace(r"^\s", f"^{WHITE}")).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        inside = set()
        for token in self.vocabulary:
            plain = token.removesuffix(self.mark)
            inside.update(zip(plain, plain[1:]))
        #: Pairs of byte letters that occur inside some token; all others are forced boundaries.
        self.joined = frozenset(inside)
        self.token_of = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.words = Memo(self._word)
        self.fragments = Memo(self._fragment)
        self.last_fragments = Memo(self._last_fragment)
        #: What a token adds to the decoded text but for the space between tokens.
        self.text_of = {i: t.encode() for i, t in self.token_of.items()}

    def cuts(self, letters: str) -> list[str]:
        """A word in byte letters, cut at its forced boundaries."""
        out, start = [], 0
        for i, pair in enumerate(zip(letters, letters[1:]), 1):
            if pair not in self.joined:
                out.append(letters[start:i])
                start = i
        return [*out, letters[start:]]

    def _merged(self, symbols: list[str]) -> bytes:
        order = self.order
        while len(symbols) > 1:
            ranks = [order.get(pair, 1 << 30) for pair in zip(symbols, symbols[1:])]
            least = min(ranks)
            if least == 1 << 30:
                break
            first, second = symbols[ranks.index(least)], symbols[ranks.index(least) + 1]
            merged, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and symbols[i] == first and symbols[i + 1] == second:
                    merged.append(first + second)
                    i += 2
                else:
                    merged.append(symbols[i])
                    i += 1
            symbols = merged
        return array("I", [self.vocabulary[s] for s in symbols]).tobytes()

    def _fragment(self, letters: str) -> bytes:
        return self._merged(list(letters))

    def _last_fragment(self, letters: str) -> bytes:
        return self._merged([*letters[:-1], letters[-1] + self.mark])

    def _plain(self, text: str) -> bytes:
        """Ids of a stretch without special tokens."""
        text = unicodedata.normalize("NFC", text)
        low = "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # each letter on its own
        out = []
        for piece in self.pieces(low):
            *first, last = self.cuts("".join([self.letters[b] for b in piece.encode()]))
            out += [self.fragments[x] for x in first]
            out.append(self.last_fragments[last])
        return b"".join(out)

    def _word(self, word: bytes) -> bytes:
        parts = self.specials.split(word.decode())
        return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in parts if p)

    def encode(self, text: bytes | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. White space parts words for good, so words are encoded one by one."""
        return b"".join(map(self.words.__getitem__, (text or b"").split()))

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, special tokens included: without a decoder in its file, a tokenizer joins its tokens with spaces."""
        return b" ".join(map(self.text_of.__getitem__, array("I", ids)))


@functools.cache
def tokenizer(path: str) -> ForcedBoundaryBpe:
    """One per process and file."""
    return ForcedBoundaryBpe(path)


def encoded(docs: DataFrame, path: str, name: str = "bpe", with_ids: bool = True) -> DataFrame:
    """``docs`` with a struct ``bpe``: ``n_tokens, ids`` (binary, little-endian unsigned 32-bit), ``decoded``, ``ids_sha256``; without ``ids`` and
    ``decoded`` but with their digests if not ``with_ids``.

    Null and empty texts, and texts of white space, have no ids and decode to an empty text. Rows are all kept, repeated ones too. Only the text
    is read; a column of ``docs`` named as the result is replaced; an empty table gives no rows.
    """
    columns = [c for c in docs.columns if c != name]
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids

    def make(batch: pa.RecordBatch) -> dict:
        bpe = tokenizer(path)
        out = [[] for _ in names]
        for text in texts(batch):
            ids = bpe.encode(text)
            back = bpe.decode(ids)
            values = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), ids, back)
            for column, value in zip(out, values):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
        if with_ids:
            arrays[4] = arrays[4].cast(pa.string())
        return {name: pa.StructArray.from_arrays(arrays, names)}

    schema = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string" + ", ids: binary, decoded: string" * with_ids
    return per_document(docs, columns, f"`{name}` struct<{schema}>", make)
