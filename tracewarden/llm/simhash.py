"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints that may be linked are brought together in buckets by a double pigeonhole: of four 16-bit
parts of two fingerprints at most ``BUDGET`` (three) bits apart, one is equal; of the other 48 bits, cut into four 12-bit
parts, one is equal again. A fingerprint thus enters 16 buckets of 28 equal bits. In a bucket the sorted
fingerprints are a binary trie; pairs of its nodes are traversed together, the bits in which they
differ add up, and a pair beyond the budget is pruned with all below it. A bucket gives the edges of a
spanning forest of its links: components stay whole, yet a group of n close copies gives at most n - 1 rows.

Hot groups: texts of equal fingerprint are one point (combined before the shuffle), so a bucket
holds distinct fingerprints that share 28 bits, 8 bytes each, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.words import free_name, per_document
from tracewarden.llm.words import texts as texts_of
from tracewarden.operators.graph import components_weak
from tracewarden.plans.skew import rows_of_keys
from tracewarden.session import written_table

SHINGLE = 3
SEED = 42
BUDGET = 3
#: Node pairs of at most this many leaf pairs are compared at once.
DIRECT = 1 << 16
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 15


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """64 majority bits over the shingle hashes; a text without words has 0. Null counts as empty."""
    words = (text or b"").lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest, n = xxhash.xxh64_intdigest, len(words) - width + 1
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, columns: list[str] | None = None, width: int = SHINGLE) -> DataFrame:
    """``columns`` (by default ``doc_id``) and ``fp``, the fingerprint as BIGINT with the same bits."""
    def make(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, width) for t in texts_of(batch)], dtype=np.uint64)
        return {"fp": fps.view(np.int64)}

    return per_document(docs, columns or ["doc_id"], "fp bigint", make)


def trie_links(fps: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For sorted distinct ``fps``: the position of each one's root in a spanning forest of the links."""
    parent = np.arange(len(fps))

    def roots(at: np.ndarray) -> np.ndarray:
        up = parent[at]
        while not np.array_equal(up, parent[up]):
            up = parent[up]
        parent[at] = up
        return up

    def compare(a: int, b: int, c: int, d: int) -> None:
        i, j = np.nonzero(np.bitwise_count(fps[a:b, None] ^ fps[None, c:d]) <= budget)
        i, j = roots(i + a), roots(j + c)
        apart = i != j
        for x, y in np.unique(np.stack([i[apart], j[apart]]), axis=1).T.tolist():
            x, y = roots(np.array([x, y])).tolist()
            parent[max(x, y)] = min(x, y)

    # A node is a range of the sorted array whose members share all bits above ``bit``.
    todo = [(0, len(fps), 0, len(fps), 63, 0)]
    while todo:
        a, b, c, d, bit, errors = todo.pop()
        if a == b or c == d or errors > budget:
            continue
        if (b - a) * (d - c) <= DIRECT or bit < 0:
            compare(a, b, c, d)
            continue
        known = roots(np.r_[a:b, c:d])
        if known.min() == known.max():  # in one component already
            continue
        m, n = (lo + int(np.searchsorted((fps[lo:hi] >> np.uint64(bit)) & np.uint64(1), 1))
                for lo, hi in ((a, b), (c, d)))
        below = [(a, m, n, d, bit - 1, errors + 1), (m, b, n, d, bit - 1, errors), (a, m, c, n, bit - 1, errors)]
        if (a, b) != (c, d):
            below.insert(0, (m, b, c, n, bit - 1, errors + 1))
        todo += below
    return roots(np.arange(len(fps)))


def _buckets(points: DataFrame) -> DataFrame:
    """``bucket, fp``: each fingerprint in its 16 buckets; the bucket names the parts and their bits."""
    def bits(column, low: int, width: int):
        return F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << width) - 1))

    fp, keys = F.col("fp"), []
    for i in range(4):
        # The 48 bits without part i, as one number.
        rest = fp.bitwiseAND(F.lit((1 << 16 * i) - 1)).bitwiseOR(
            F.shiftleft(F.shiftrightunsigned(fp, 16 * i + 16) if i < 3 else F.lit(0).cast("bigint"), 16 * i))
        for j in range(4):
            keys.append(F.lit((4 * i + j) << 28) + F.shiftleft(bits(fp, 16 * i, 16), 12) + bits(rest, 12 * j, 12))
    return points.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the buckets of a partition sorted by bucket. Only one bucket is held over batches."""
    name = None
    held: list[np.ndarray] = []

    def edges() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fps = held[0] if len(held) == 1 else np.concatenate(held)
        if len(fps) > 1:
            fps = np.unique(fps)
            roots = trie_links(fps)
            linked = roots != np.arange(len(fps))
            if linked.any():
                yield fps[linked], fps[roots[linked]]

    def rows(pairs) -> pa.RecordBatch:
        a, b = (np.concatenate([p[k] for p in pairs]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    for batch in batches:
        buckets, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        fps = fps.astype(np.int64).view(np.uint64)
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        # Buckets of one fingerprint, most of them, need no look; the first and last may go on elsewhere.
        bounds = np.concatenate([[0], cuts, [len(fps)]])
        sizes = np.diff(bounds)
        some = np.flatnonzero(sizes > 1)
        found = []
        for k in np.unique(np.concatenate([[0], some, [len(sizes) - 1]])) if len(fps) else ():
            lo, hi = bounds[k], bounds[k + 1]
            if held and buckets[lo] != name:
                found += edges()
                held = []
            name = buckets[lo]
            held.append(fps[lo:hi])
        if found:
            yield rows(found)
    if held and (found := list(edges())):
        yield rows(found)


def links(points: DataFrame, partitions: int | None = None) -> DataFrame:
    """``src, dst``: edges between the distinct fingerprints ``points(fp)`` that keep all components."""
    placed = _buckets(points.select("fp").distinct())
    placed = placed.select("bucket", "fp")
    placed = placed.repartition(partitions, "bucket") if partitions else placed.repartition("bucket")
    return placed.sortWithinPartitions("bucket").mapInArrow(_bucket_edges, "src bigint, dst bigint").distinct()


def components(points: DataFrame) -> DataFrame:
    """``fp, component`` for the fingerprints that have a link; the others are their own component."""
    return components_of(links(points))


def components_of(edges: DataFrame) -> DataFrame:
    """``fp, component`` for the nodes of ``edges(src, dst)``."""
    pairs = written_table(edges, "simhash-links")
    if pairs.isEmpty():
        return pairs.select(F.col("src").alias("fp"), F.col("dst").alias("component"))
    unit = F.lit(1).cast("bigint")
    # The graph operator ranks nodes by the order of insertion; a dense number per edge gives one.
    numbered = pairs.select("src", "dst", unit.alias("weight"), F.monotonically_increasing_id().alias("first_seq"))
    return components_weak(written_table(numbered, "simhash-edges")).select(
        F.col("node").alias("fp"), "component")


def _placed(rows: DataFrame) -> DataFrame:
    """``fp, component`` for every fingerprint of ``rows(fp, ...)``."""
    points = written_table(rows.select("fp").distinct(), "simhash-points")
    member = components(points).withColumnRenamed("fp", "_fp")
    return points.join(member, points["fp"] == member["_fp"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs(doc_id, text)``.

    Rows whose fingerprints differ in at most three bits are linked, and ``component_id`` is the smallest
    ``doc_id`` that links lead to, itself included. Null and empty texts, and texts of white space, have fingerprint
    zero and are linked like any other. A row without ``doc_id`` is kept and names no component (null
    where all of its component are so). Repeated rows are all returned; an empty table gives no rows; columns
    other than the two are not read.
    """
    rows = written_table(fingerprints(docs), "simhash-fingerprints")
    placed = _placed(rows).join(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_point = written_table(placed.join(least, "component").select("fp", "component_id"), "simhash-components")
    return rows.join(by_point, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs(doc_id, text, ...)``, with all columns: that of the smallest ``doc_id`` (a null one only where there is no other),
    of its texts that with the smallest digest; rows that repeat id and text leave one of themselves."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.concat(text("doc_id"), F.lit("|"), text("text")))))
    rows = written_table(fingerprints(keyed, ["doc_id", key]), "simhash-rows")
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("least"))
    stay = _placed(rows).join(first, "fp").groupBy("component").agg(F.min("least").alias("least"))
    stay = written_table(stay.select(f"least.{key}"), "simhash-stay")
    return rows_of_keys(keyed, stay, [key]).dropDuplicates([key]).drop(key)
