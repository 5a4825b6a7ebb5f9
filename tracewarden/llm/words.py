"""Words, their hashes, and batches of documents as tasks see them.

A word is a longest run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; ``bytes.split()`` cuts at
exactly these. Texts travel as UTF-8 bytes, so nothing is decoded where it needn't be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

#: Entries that a per-process memo may hold before it starts anew; it only saves time.
MEMO_ENTRIES = 700_000
#: Documents that are worked on at once.
SLICE_ROWS = 1024
#: Base of the rolling hashes modulo 2**64 (odd, hence invertible).
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Memo(dict):
    """A dict that computes missing values and starts anew at its limit, so its memory is bounded."""

    def __init__(self, make: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


#: Hashing a word anew is cheap, so fewer are remembered.
word_hash = Memo(xxhash.xxh64_intdigest, 250_000)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hash.__getitem__, words), dtype=np.uint64, count=len(words))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for ``i < n``; kept for the next text."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(2 * n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class RollingHash:
    """Hashes of all runs of words of a text, from prefix sums: the same words give the same hash."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up, self.down = _powers_to(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:n], out=self.sums[1:])

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of the windows of ``width`` words, by their start; empty for shorter texts."""
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    """The texts of a batch as UTF-8 bytes, one at a time."""
    for value in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()):
        yield value.as_py()


def per_document(docs: DataFrame, columns: list[str], schema: str, make: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """One output row per document: ``columns`` as they are, and what ``make`` returns for a batch
    (name to list or array, in the order of ``schema``)."""
    kept = docs.select(*columns, *(["text"] if "text" not in columns else []))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                made = make(part)
                arrays = [part.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(
                    arrays + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()], columns + list(made))

    return kept.mapInArrow(run, ", ".join(fields + [schema]))
