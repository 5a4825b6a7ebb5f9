"""Token ids in wavelet-matrix files, one per shard.

A shard holds whole documents in ascending order of ``doc_id``. Its ids are stored as bit-planes from the highest bit down; after each plane
the ids are dealt stably, zeros before ones. With rank directories this gives access to any token, counts and places of an id, from one
file of compressed sections: header (JSON), the planes, documents' ids and starts.

Documents are dealt by range of ``doc_id`` (the texts are shuffled, which is smaller than the ids' work), and a task writes a file whenever its
buffer is full, so its memory is bounded by a shard and one document. A file is written under a name of its own attempt and then renamed:
a task that runs again writes the same file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewarden.llm.encode import encoder
from tracewarden.llm.words import texts
from tracewarden.session import new_folder, written_table

MAGIC = b"WVM1"
#: Tokens at which a shard is closed, bits between two entries of the rank directory, and bytes of text for a task.
SHARD_TOKENS = 2 << 20
RANK_BITS = 512
TASK_BYTES = 32 << 20
CODEC = "zstd"


class WaveletMatrix:
    def __init__(self, length: int, planes: list[np.ndarray]):
        """``planes``: packed bits, the highest plane first, each padded to a multiple of ``RANK_BITS``."""
        self.length, self.planes = length, planes
        self.ranks = [np.concatenate([[0], np.cumsum(np.bitwise_count(p).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.int64))])
                      for p in planes]
        self.zeros = [length - int(r[-1]) for r in self.ranks]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        dealt, planes = np.empty_like(rest), []
        for b in range(bits - 1, -1, -1):
            ones = rest & rest.dtype.type(1 << b) != 0
            packed = np.packbits(ones)
            planes.append(np.pad(packed, (0, -len(packed) % (RANK_BITS // 8))))
            if b:
                zeros = len(rest) - int(np.count_nonzero(ones))
                np.compress(~ones, rest, out=dealt[:zeros])
                np.compress(ones, rest, out=dealt[zeros:])
                rest, dealt = dealt, rest
        return cls(len(ids), planes)

    def _ones_before(self, plane: int, at: int) -> int:
        block, byte = at // RANK_BITS, at // 8
        p = self.planes[plane]
        count = int(self.ranks[plane][block]) + int(np.bitwise_count(p[block * (RANK_BITS // 8):byte]).sum())
        return count + (int(p[byte]) >> (8 - at % 8)).bit_count() if at % 8 else count

    def _step(self, plane: int, bit: int, at: int) -> int:
        ones = self._ones_before(plane, at)
        return self.zeros[plane] + ones if bit else at - ones

    def access(self, at: int) -> int:
        value = 0
        for k, p in enumerate(self.planes):
            bit = int(p[at // 8]) >> (7 - at % 8) & 1
            at = self._step(k, bit, at)
            value = value << 1 | bit
        return value

    def _bits(self, token: int) -> list[int] | None:
        n = len(self.planes)
        return None if token < 0 or token >> n else [token >> (n - 1 - k) & 1 for k in range(n)]

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` before position ``end``."""
        bits = self._bits(token)
        if bits is None:
            return 0
        a, b = 0, end
        for k, bit in enumerate(bits):
            a, b = self._step(k, bit, a), self._step(k, bit, b)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence number ``k`` (from 0) of ``token``."""
        if not 0 <= k < self.rank(token, self.length):
            raise IndexError(k)
        bits = self._bits(token)
        at = 0
        for i, bit in enumerate(bits):
            at = self._step(i, bit, at)
        at += k
        for i in range(len(bits) - 1, -1, -1):
            at = self._find(i, bits[i], at - (self.zeros[i] if bits[i] else 0))
        return at

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Position of the bit number ``k`` (from 0) that equals ``bit``."""
        ranks = self.ranks[plane]
        counts = ranks if bit else np.arange(len(ranks)) * RANK_BITS - ranks
        block = int(np.searchsorted(counts, k, side="right")) - 1
        step = RANK_BITS // 8
        inside = np.unpackbits(self.planes[plane][block * step:(block + 1) * step])
        return block * RANK_BITS + int(np.flatnonzero(inside == bit)[k - int(counts[block])])

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane back up."""
        rest = np.zeros(self.length, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for weight, (p, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(p, count=self.length).view(bool)
            above = np.empty_like(rest)
            above[~ones] = rest[:zeros]
            above[ones] = rest[zeros:] | rest.dtype.type(1 << weight)
            rest = above
        return rest.astype("<u4")


def to_file(matrix: WaveletMatrix, doc_ids: list[int | None], starts: np.ndarray, shard: int) -> bytes:
    """The file of a shard. ``starts`` has one entry more than ``doc_ids``; a null id is noted in the header."""
    plain = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    parts = [p.tobytes() for p in matrix.planes] + [plain, starts.astype("<i8").tobytes()]
    packed = [pa.compress(p, codec=CODEC, asbytes=True) if p else b"" for p in parts]
    header = json.dumps({
        "shard": shard, "length": matrix.length, "planes": len(matrix.planes), "docs": len(doc_ids),
        "null_docs": [i for i, d in enumerate(doc_ids) if d is None],
        "sections": [[len(p), len(c)] for p, c in zip(parts, packed)]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *packed])


def from_file(content: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray, int]:
    if content[:4] != MAGIC:
        raise ValueError("not a wavelet-matrix file")
    at = 8 + int.from_bytes(content[4:8], "little")
    header = json.loads(content[8:at])
    parts = []
    for plain, packed in header["sections"]:
        parts.append(pa.decompress(content[at:at + packed], decompressed_size=plain, codec=CODEC, asbytes=True) if plain else b"")
        at += packed
    n = header["planes"]
    matrix = WaveletMatrix(header["length"], [np.frombuffer(p, dtype=np.uint8) for p in parts[:n]])
    doc_ids: list[int | None] = np.frombuffer(parts[n], dtype="<i8").tolist()
    for i in header["null_docs"]:
        doc_ids[i] = None
    return matrix, doc_ids, np.frombuffer(parts[n + 1], dtype="<i8"), header["shard"]


def write(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Write ``docs(doc_id, text)`` to files under ``folder`` and return a stored table of them: ``shard, file, n_tokens, n_docs``, the
    shards numbered in ascending order of ``doc_id``.

    ``folder`` is a URI that Spark and pyarrow both know. Rows without an id come first; rows of one id in the order of
    their texts. Null and empty texts are the end id alone. An empty table writes no files. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // TASK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        partition, made = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        ids: list[int | None] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids, tokens, made
            shard = partition << 32 | made
            starts = np.concatenate([[0], np.cumsum([len(b) // 4 for b in held])])
            data = to_file(WaveletMatrix.of(np.frombuffer(b"".join(held), dtype="<u4")), ids, starts, shard)
            store, where = pa.fs.FileSystem.from_uri(folder)
            store.create_dir(where, recursive=True)
            name = f"shard-{shard:016x}.wvm"
            draft = f"{where}/_{name}-{uuid.uuid4().hex}"  # readers skip names with an underscore
            with store.open_output_stream(draft) as out:
                out.write(data)
            store.move(draft, f"{where}/{name}")
            row = [[shard], [name], [tokens], [len(ids)]]
            held, ids, tokens, made = [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["shard", "file", "n_tokens", "n_docs"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                held.append(encode(text) + end)
                ids.append(doc_id)
                tokens += len(held[-1]) // 4
                if tokens >= SHARD_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    ranged = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return written_table(ranged.mapInArrow(run, "shard bigint, file string, n_tokens bigint, n_docs bigint"), "wavelet-shards")


def read(spark, folder: str, shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from the files; ``start`` counts the ids of all documents before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                matrix, doc_ids, starts, shard = from_file(content.as_py())
                data = matrix.ids().tobytes()
                cuts = starts.tolist()
                crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array([shard] * len(doc_ids), pa.int64()), pa.array(starts[:-1]),
                     pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], ["doc_id", "shard", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("content")
    rows = files.mapInArrow(run, "doc_id bigint, shard bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    # Sums by range first: the one window without partitions sees a row per range, not per file.
    group = F.shiftright("shard", 32)
    inner = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    known = shards.select("shard", group.alias("range"), "n_tokens")
    ranges = known.groupBy("range").agg(F.sum("n_tokens").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before"))
    base = known.withColumn("within", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(ranges, "range").select(
        "shard", (F.col("before") + F.col("within")).alias("base"))
    return rows.join(base, "shard").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def stored_tokens(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write ``docs`` under the shared folder and read the files back: see :func:`write` and :func:`read`."""
    spark = docs.sparkSession
    folder = new_folder(spark, "wavelet-files")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    shards = write(docs, path, end_id, folder)
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read(spark, folder, shards)
