"""File-order keys and the chunks that ordered work is split by.

An order key is either a BIGINT (``packet_no``, ``line_no``) or the struct that the scans add:
``(path, block, pos)``. Keys are unique, so chunks of equal width hold a bounded number of rows. A BIGINT key with wide gaps
would give more chunks than that needs; such a key is cut at quantiles of its values instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows per chunk, and chunks per group of chunks.
CHUNK_ROWS = 1 << 16
CHUNK_GROUP = 1 << 12
#: A key with more values between its ends than this for each row is cut at quantiles, into so many ranges at most.
SPARSE = 4
RANGES = 1 << 12


def scan_key() -> Column:
    """Order key for file scans; select it next to the scan, before any filter or shuffle.

    Inside one file block ids ascend in read order. Blocks are compared by path and offset, so
    the way splits are packed into tasks does not matter.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


@dataclass(frozen=True)
class Chunks:
    """How an order key is cut: by ``width``, or where ``bounds`` are given into the ranges between them, each in ``parts``.
    ``rows`` is the number of rows that it was found for."""

    width: int
    struct: bool
    bounds: tuple[int, ...] = ()
    parts: int = 1
    rows: int = 0

    def tasks(self, least: int) -> int | None:
        """Tasks that leave each of them a chunk or a few, where that takes more than ``least``."""
        wanted = 2 * -(-self.rows // self.width)
        return wanted if wanted > least else None

    def of(self, key: Column) -> Column:
        """The chunk of a row with that key; chunks sort in the same order as the rows."""
        if self.struct:
            return F.struct(
                key["path"].alias("path"), key["block"].alias("block"), F.floor(key["pos"] / self.width).alias("part"))
        if not self.bounds:
            return F.floor(key / self.width)
        # One literal, whose type Catalyst folds.
        bounds = F.split(F.lit(",".join(map(str, self.bounds))), ",").cast("array<bigint>")
        steps = [1 << i for i in reversed(range(len(self.bounds).bit_length()))]
        at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda i, step: F.when(
            F.get(bounds, i + step) <= key, i + step).otherwise(i)).cast("bigint")
        if self.parts == 1:
            return at
        low, high = F.get(bounds, at.cast("int")), F.get(bounds, at.cast("int") + 1)
        part = F.floor((key.cast("double") - low) / (high.cast("double") - low) * self.parts)
        return at * self.parts + F.least(F.coalesce(part, F.lit(0)), F.lit(self.parts - 1))

    def group(self, chunk: Column) -> Column:
        """A coarser unit over chunks: the file, the range, or a run of ``CHUNK_GROUP`` chunks."""
        if self.struct:
            return chunk["path"]
        return F.floor(chunk / (self.parts if self.bounds else CHUNK_GROUP))


def chunks_of(df: DataFrame, order: str, width: int = CHUNK_ROWS) -> Chunks:
    """Chunks of about ``width`` rows for the values of ``order``.

    One pass counts the rows and, unless the key is a struct, takes its extent. Where it has more than ``SPARSE`` values a row, a second one takes
    approximate quantiles, at most ``RANGES`` of them: the only values of the data that reach the driver.
    """
    if isinstance(df.schema[order].dataType, T.StructType):
        return Chunks(width, True, rows=df.count())
    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    if not n or high - low <= SPARSE * max(n, width):
        return Chunks(width, False, rows=n)
    ranges = min(RANGES, -(-n // width))
    at = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    inner = df.agg(F.percentile_approx(order, at, 10 * RANGES)).first()[0] if ranges > 1 else []
    bounds = sorted({low, *inner})
    return Chunks(width, False, (*bounds, high + 1), max(1, -(-n // (width * ranges))), n)
