"""Token counts without token ids leaving the task: batch encoding in Arrow functions that return lengths only.

A task gathers texts up to a number of bytes, hands them to the sentencepiece library in one call and keeps the lengths. Long texts
are first split where the model can't join what it separates: a merged piece consists of neighbouring characters, so between
two characters that are neighbours in no piece of the vocabulary nothing is ever merged. The library puts a space before what it
encodes. A fragment that follows such a cut at a space gives up its space for that one; any other fragment must begin with a character
that joins no space before it, and the added space's own token is taken off its count.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tracewarden.llm.words import free_name, per_document

#: Characters from which on a text is split, about the size of a fragment.
FRAGMENT = 1 << 14
#: Bytes of one call of the library; a fragment that can't be split may be larger.
BATCH_BYTES = 1 << 20
SPACE = "▁"


class Pieces:
    """A sentencepiece model and the pairs of neighbouring characters in its vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        normal = [n for n in range(self.library.get_piece_size())
                  if not (self.library.is_byte(n) or self.library.is_control(n) or self.library.is_unknown(n))]
        names = [self.library.id_to_piece(n) for n in normal]
        self.joined = {pair for name in names for pair in zip(name, name[1:])}
        # Cuts rely on white space being kept as it is, one space before each text, and no other normalisation.
        self.splits = all(self.library.encode(a, out_type=str) == b for a, b in (
            ("a  b\n", [SPACE + "a", SPACE, SPACE + "b", "<0x0A>"]), (" ", [SPACE * 2]), ("ﬁ½", [SPACE, "ﬁ", "½"])))

    def _cut(self, text: str, at: int) -> int:
        """The first place from ``at`` on where the text can be cut, or its end."""
        joined = self.joined
        for i in range(at, len(text) - 1):
            left, right = text[i - 1], text[i]
            if left == " ":
                left = SPACE
            if right == " " or right == SPACE:
                if (left, SPACE) not in joined:
                    return i
            elif (left, right) not in joined and (SPACE, right) not in joined:
                return i
        return len(text)

    def fragments(self, text: str) -> Iterator[tuple[str, int]]:
        """Fragments and what to add to the count of their tokens: the sums over a text are its tokens."""
        if len(text) <= FRAGMENT or not self.splits:
            yield text, 0
            return
        start, extra = 0, 0
        while start < len(text):
            end = self._cut(text, start + FRAGMENT) if len(text) - start > FRAGMENT else len(text)
            yield text[start:end], extra
            start, extra = end, -1
            if end < len(text) and text[end] in (" ", SPACE):
                start, extra = end + 1, 0

    def counts(self, texts: Iterator[str | None], n: int) -> np.ndarray:
        """The tokens of ``n`` texts."""
        found = np.zeros(n, dtype=np.int64)
        pending, owners, size = [], [], 0

        def flush():
            ids = self.library.encode(pending, num_threads=1)
            np.add.at(found, owners, np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))

        for k, text in enumerate(texts):
            for fragment, extra in self.fragments(text) if text else ():
                pending.append(fragment)
                owners.append(k)
                found[k] += extra
                size += len(fragment)
                if size >= BATCH_BYTES:
                    flush()
                    pending, owners, size = [], [], 0
        if pending:
            flush()
        return found


@functools.cache
def pieces(path: str) -> Pieces:
    """One model per process and file."""
    return Pieces(path)


def counted(docs: DataFrame, path: str, limit: int = 4096, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all unless named) with a struct ``tokens``: ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    Null and empty texts have no tokens. Long texts are encoded in fragments; one that can't be split is encoded whole. Every row
    gives one row, repeated rows too; ids are not read. An empty table gives an empty one. A column of ``docs`` called ``tokens``
    stays, and the struct's name then ends in an underscore. The path must name the file on every executor.
    """
    kept = docs.columns if columns is None else columns
    name = free_name(docs.select(*kept), "tokens")

    def make(batch: pa.RecordBatch) -> dict:
        column = batch.column(batch.schema.get_field_index("text"))
        size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
        n = pieces(path).counts((value.as_py() for value in column), len(column))
        return {name: pa.StructArray.from_arrays([size, pa.array(n), pa.array(n > limit)], ["n_bytes", "n_tokens", "over_limit"])}

    return per_document(docs, kept, f"`{name}` struct<n_bytes: bigint, n_tokens: bigint, over_limit: boolean>", make)
