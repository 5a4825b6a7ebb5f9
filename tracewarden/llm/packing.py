"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

A document longer than a sequence is cut into full pieces from its end; its first piece may be shorter. Pieces are dealt by a
hash to tasks of bounded size and arrive there longest first. A task places each piece where the sum, over the
residual gaps, of the squared number of open sequences with that gap becomes smallest (of equals: where the smallest
gap is left); a new sequence is one of the places when no open one fits. Only the open sequences are held in memory: the rows stream through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.encode import encoder
from tracewarden.llm.words import texts
from tracewarden.session import written_table

SIZE = 2048
#: Pieces that one task packs on average.
TASK_PIECES = 200_000


def pieces(docs: DataFrame, path: str, end_id: int, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, binary) of all documents: the ids of the tokenizer file ``path``, then ``end_id``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            which, out = [], [[] for _ in names]
            for row, text in enumerate(texts(batch)):
                ids = encode(text) + end
                n = len(ids) // 4
                at = 0
                for k in range(-(-n // size)):
                    stop = n - (-(-n // size) - 1 - k) * size
                    part = ids[4 * at:4 * stop]
                    which.append(row)
                    for column, value in zip(out, (k, at, stop - at, zlib.crc32(part), part)):
                        column.append(value)
                    at = stop
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64())), *[pa.array(c, t) for c, t in zip(out, kinds)]], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


class SumOfSquares:
    """Open sequences by residual gap. ``place`` says in which sequence, and where there, a length goes."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.count = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        assert 0 < length <= self.size
        gaps = self.count[length:self.size]
        some = np.flatnonzero(gaps)
        if len(some):
            # Moving one from gap g to g - length: g's square falls by 2 n - 1, the other's rises by 2 m + 1.
            left = self.count[some]
            change = 2 * left + 2 - 2 * gaps[some]
            if some[0] == 0:  # filled up: no open sequence is added
                change[0] = 1 - 2 * gaps[0]
            gap = int(some[int(change.argmin())]) + length
            sequence = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            gap, sequence = self.size, self.opened
            self.opened += 1
        if gap > length:
            self.open[gap - length].append(sequence)
            self.count[gap - length] += 1
        return sequence, self.size - gap


def pack(rows: DataFrame, size: int = SIZE, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``rows`` (any columns, among them ``length`` from 1 to ``size``) with ``sequence_id, offset``.

    ``rows`` is read twice (it is counted first): pass a stored table. Equal rows are placed one by one; an empty table gives no
    rows. Columns named ``sequence_id`` or ``offset`` are replaced. Sequence ids are unique, not dense.
    """
    rows = rows.drop("sequence_id", "offset")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    parts = max(1, -(-rows.count() // task_pieces))
    order = [F.desc("length"), *[F.col(c) for c in rows.columns if c != "length"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = SumOfSquares(size), TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
            placed = [bins.place(n) for n in lengths]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"])

    dealt = rows.repartition(parts, F.xxhash64(*rows.columns)).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, doc_ids`` from packed pieces with ``ids``: what a trainer reads. A sequence has ``size`` tokens at most."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_tokens"),
        F.unhex(F.array_join("p.ids", "")).alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def packed_documents(docs: DataFrame, path: str, end_id: int, size: int = SIZE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for ``docs(doc_id, text)``.

    Null and empty texts are the end id alone. Null ids and repeated rows are packed like any other; an empty table gives no
    rows; other columns are not read.
    """
    return pack(written_table(pieces(docs, path, end_id, size), "packing-pieces"), size)
