"""WARC replicas and their Merkle fixity audit.

Pages become WARC files of bounded size: a gzip member per record, the first being a ``warcinfo`` record whose block lists the byte lengths of the
records that follow. A file thus tells its own ordered offset ranges, and hashing it takes one read and no join.

Leaves are hashes of the offset ranges of the records (0: the ``warcinfo`` record; bytes beyond the last record are one more leaf). Inner nodes
hash up to ``FANOUT`` children in order: ``FILE_HEIGHT`` levels inside a file (made in the task that reads it), then one node for the files of
a group, then groups by sixteens up to the root. The trees of replicas are stored by height. The audit compares roots and reads, height by height,
only the children of nodes that differ.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.words import texts
from tracewarden.session import new_folder, written_table

FANOUT = 16
#: Levels inside a file; its records are at most FANOUT ** FILE_HEIGHT.
FILE_HEIGHT = 4
FILE_BYTES, FILE_RECORDS = 16 << 20, FANOUT ** FILE_HEIGHT - 2
#: Bytes of pages that one task writes.
GROUP_BYTES = 64 << 20


def record(page_id: int | None, url: bytes, html: bytes) -> bytes:
    """A ``resource`` record in a gzip member. The same page gives the same bytes. Line ends in a url are percent-encoded."""
    uri = url.replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {hashlib.sha256(url + html).hexdigest()}")
    head = b"".join([
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:", str(name).encode(), b">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: ", uri,
        b"\r\nContent-Type: text/html\r\nContent-Length: ", str(len(html)).encode(), b"\r\n\r\n"])
    return gzip.compress(head + html + b"\r\n\r\n", 6, mtime=0)


def file_of(records: list[bytes]) -> bytes:
    block = " ".join(str(len(r)) for r in records).encode()
    head = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/plain\r\nContent-Length: " + str(len(block)).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0) + b"".join(records)


def ranges(content: bytes) -> list[tuple[int, int]]:
    """The offset ranges ``[start, end)`` of a file's leaves. A file whose first record can't be read is one leaf."""
    try:
        reader = zlib.decompressobj(31)
        head = reader.decompress(content)
        if not reader.eof:
            raise ValueError("no end of the first record")
        lengths = [int(x) for x in head.split(b"\r\n\r\n")[1].split()]
    except (zlib.error, ValueError, IndexError):
        return [(0, len(content))]
    at = len(content) - len(reader.unused_data)
    out = [(0, at)]
    for n in lengths:
        out.append((min(at, len(content)), min(at + n, len(content))))
        at += n
    if at < len(content):
        out.append((at, len(content)))
    return out


def tree(content: bytes) -> list[list[tuple[bytes, int, int]]]:
    """Nodes ``hash, start, end`` by height: the leaves, ..., the file's root (at ``FILE_HEIGHT``)."""
    levels = [[(hashlib.sha256(content[a:b]).digest(), a, b) for a, b in ranges(content)]]
    for _ in range(FILE_HEIGHT):
        below = levels[-1]
        levels.append([(hashlib.sha256(b"".join(h for h, _, _ in some)).digest(), some[0][1], some[-1][2])
                       for some in (below[i:i + FANOUT] for i in range(0, len(below), FANOUT))])
    return levels


def write(pages: DataFrame, folders: list[str], damaged: Column | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as the same files to all ``folders`` and return the stored list of records:
    ``page_id, grp, file, idx``. In the folders after the first, a bit in the middle of a ``damaged`` record is flipped (for drills).

    Folders are URIs that Spark and pyarrow both know. Null urls and texts are empty; repeated rows are records of their own; an empty table writes
    no files. Rows are dealt by a hash of all three columns, so one host or id may hold most of them.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), text("url").alias("url"), text("html").alias("html"),
        (F.lit(False) if damaged is None else F.coalesce(damaged, F.lit(False))).alias("hurt"))
    size = rows.agg(F.sum(F.octet_length("html") + F.octet_length("url")).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // GROUP_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, made = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        ids: list[int | None] = []
        hurt: list[int] = []
        filled = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids, hurt, filled, made
            name = f"g{group:07d}-{made:05d}.warc.gz"
            for k, folder in enumerate(folders):
                records = list(held)
                data = bytearray(file_of(records))
                if k:
                    base = len(data) - filled
                    starts = [0]
                    for r in records:
                        starts.append(starts[-1] + len(r))
                    for i in hurt:
                        data[base + (starts[i] + starts[i + 1]) // 2] ^= 1
                store, where = pa.fs.FileSystem.from_uri(folder)
                store.create_dir(where, recursive=True)
                draft = f"{where}/_{name}-{uuid.uuid4().hex}"
                with store.open_output_stream(draft, compression=None) as out:
                    out.write(bytes(data))
                store.move(draft, f"{where}/{name}")
            n = len(ids)
            columns = [pa.array(ids, pa.int64()), pa.array([group] * n, pa.int64()), pa.array([made] * n, pa.int64()), pa.array(range(1, n + 1), pa.int64())]
            held, ids, hurt, filled, made = [], [], [], 0, made + 1
            return pa.RecordBatch.from_arrays(columns, ["page_id", "grp", "file", "idx"])

        for batch in batches:
            flags = batch.column(3).to_pylist()
            for page_id, url, html, flag in zip(batch.column(0).to_pylist(), texts(batch, "url"), texts(batch, "html"), flags):
                if flag:
                    hurt.append(len(held))
                held.append(record(page_id, url, html))
                ids.append(page_id)
                filled += len(held[-1])
                if filled >= FILE_BYTES or len(held) >= FILE_RECORDS:
                    yield flush()
        if held:
            yield flush()

    dealt = rows.repartition(groups, F.xxhash64("page_id", "url", "html")).sortWithinPartitions("page_id", "url", "html")
    return written_table(dealt.mapInArrow(run, "page_id bigint, grp bigint, file bigint, idx bigint"), "warc-records")


def nodes(spark, folder: str) -> DataFrame:
    """The stored tree of a replica: ``height, grp, file, idx, parent, hash, start, end``. Above files, ``grp`` numbers the node and ``file`` is -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                group, number = (int(x) for x in path.rsplit("/", 1)[1][1:].split(".")[0].split("-"))
                out = [(h, group, number, i, i // FANOUT, *node) for h, level in enumerate(tree(content.as_py())) for i, node in enumerate(level)]
                kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["height", "grp", "file", "idx", "parent", "hash", "start", "end"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content")
    schema = "height int, grp bigint, file bigint, idx bigint, parent bigint, hash binary, start bigint, end bigint"
    inside = new_folder(spark, "warc-tree")
    files.mapInArrow(run, schema).write.partitionBy("height").parquet(inside)
    level = spark.read.parquet(inside).filter(F.col("height") == FILE_HEIGHT).select("grp", F.col("file").alias("child"), "hash")
    height, above = FILE_HEIGHT, []
    while True:
        height += 1
        kids = F.array_sort(F.collect_list(F.struct("child", F.hex("hash").alias("h"))))
        level = written_table(level.groupBy("grp").agg(F.unhex(F.sha2(F.unhex(F.array_join(kids["h"], "")), 256)).alias("hash")), "warc-tree-top")
        above.append(level.select(
            F.lit(height).alias("height"), "grp", F.lit(-1).cast("bigint").alias("file"), F.lit(0).cast("bigint").alias("idx"),
            F.floor(F.col("grp") / FANOUT).alias("parent"), "hash", F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end")))
        if level.filter("grp > 0").isEmpty():
            break
        level = level.select(F.floor(F.col("grp") / FANOUT).alias("grp"), F.col("grp").alias("child"), "hash")
    for part in above:
        part.write.mode("append").partitionBy("height").parquet(inside)
    return spark.read.schema(schema).parquet(inside)


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Leaves in which two trees of :func:`nodes` differ: ``grp, file, idx, start, end, status``, found from the roots down.

    ``status`` is ``changed``, ``missing`` (not in the second replica) or ``extra`` (only there). ``start`` and ``end`` are the range in the first replica, or
    else in the second. Equal trees give no rows.
    """
    keys = ["grp", "file", "idx"]
    top = max(t.agg(F.max("height").alias("h")).first()["h"] or 0 for t in (first, second))
    wanted = None
    for height in range(top, -1, -1):
        a, b = (t.filter(F.col("height") == height).drop("height") for t in (first, second))
        if wanted is not None:
            # The children of what differs; other subtrees are not looked at.
            if height >= FILE_HEIGHT + 1:
                on, parents = ["parent"], wanted.select(F.col("grp").alias("parent"))
            elif height == FILE_HEIGHT:
                on, parents = ["grp"], wanted.select("grp")
            else:
                on, parents = ["grp", "file", "parent"], wanted.select("grp", "file", F.col("idx").alias("parent"))
            a, b = (t.join(parents.distinct(), on, "left_semi") for t in (a, b))
        pair = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in ("hash", "start", "end")]).join(
            b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in ("hash", "start", "end")]), keys, "full")
        differ = pair.filter(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
        status = F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "extra").otherwise("changed")
        wanted = written_table(differ.select(
            *keys, F.coalesce("a_start", "b_start").alias("start"), F.coalesce("a_end", "b_end").alias("end"), status.alias("status")), f"warc-differ-{height}")
    return wanted


def audited_replicas(pages: DataFrame, damaged: Column | None = None) -> DataFrame:
    """Write two replicas of ``pages`` under the shared folder, audit the second against the first, and name the pages of the records that differ:
    ``page_id, file, record, start, end, status``. Record 0 of a file is its ``warcinfo`` and names no page.
    """
    spark = pages.sparkSession
    folders = []
    for name in ("warc-first", "warc-second"):
        folder = new_folder(spark, name)
        folders.append(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    records = write(pages, folders, damaged)
    if records.isEmpty():
        return spark.createDataFrame([], "page_id bigint, file string, record bigint, start bigint, end bigint, status string")
    found = audit(*(nodes(spark, f) for f in folders))
    name = F.format_string("g%07d-%05d.warc.gz", "grp", "file")
    return found.join(records, ["grp", "file", "idx"], "left").select(
        "page_id", name.alias("file"), F.col("idx").alias("record"), "start", "end", "status")
