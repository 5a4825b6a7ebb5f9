"""The objects of JSON arrays of any size, read by many tasks.

A file is cut at every closing brace by the text reader, which does that in all its blocks at once. Whether such a brace ends an object
depends on what comes before: how many braces are open, and whether a string is. For each block a first pass finds what the block
makes of either start, inside and outside a string. Put together in order of the blocks, these give each block's true start, and a
second pass then takes out its objects. An object that reaches over a block's end is put together from its parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: What follows the last object, and what stands before each.
_END = r"^\s*(\[\s*)?\]\s*$"
_BEFORE = r"^\s*[\[,]\s*"
#: Kinds of pieces: an object, the end of one, the beginning of one, and what lies between.
_WHOLE, _HEAD, _TAIL, _MIDDLE = range(4)


class _Fragments:
    """Quotes and opened braces of fragments, for a start outside (0) and inside (1) a string. Escaped characters count as nothing."""

    def __init__(self, values: pa.Array):
        plain = pc.replace_substring_regex(values, r"(?s)\\.", "")
        strings = r'"[^"]*("|$)'
        outside = pc.replace_substring_regex(plain, strings, "")
        inside = pc.replace_substring_regex(pc.replace_substring_regex(plain, r'^[^"]*("|$)', ""), strings, "")
        count = lambda a, c: pc.count_substring(a, c).to_numpy(zero_copy_only=False).astype(np.int64)
        self.quotes = count(plain, '"')
        self.opened = np.stack([count(outside, "{"), count(inside, "{")])

    def run(self, string: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From a start inside a string or not: what each fragment adds to the depth, whether the brace after it closes one, and
        whether a string is open after it."""
        after = (string + np.cumsum(self.quotes)) % 2
        start = np.concatenate([[string], after[:-1]])
        closes = after == 0
        return self.opened[start, np.arange(len(start))] - closes, closes, after


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Path, block and consecutive fragments; a block may come in several stretches."""
    for batch in batches:
        paths, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        cuts = [0, *(i for i in range(1, len(paths)) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]), len(paths)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield paths[a], blocks[a], batch.column(0).slice(a, b - a)


def _key(path: str, block: int) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{block}")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: strings left open (0 or 1) and depth added for both starts, and whether it may end its file."""
    known: dict[tuple[str, int], list] = {}
    for path, block, values in _stretches(batches):
        at = known.setdefault((path, block), [[0, 0], [1, 0], False])
        fragments = _Fragments(values)
        for state in at[:2]:
            added, _, after = fragments.run(state[0])
            state[0], state[1] = int(after[-1]), state[1] + int(added.sum())
        at[2] = pc.match_substring_regex(values.slice(len(values) - 1), _END)[0].as_py()
    yield pa.RecordBatch.from_pylist(
        [{"path": p, "block": b, "string": s[0][0], "depth0": s[0][1], "depth1": s[1][1], "ends": s[2]} for (p, b), s in known.items()],
        pa.schema([("path", pa.string()), ("block", pa.int64()), ("string", pa.int32()), ("depth0", pa.int64()),
                   ("depth1", pa.int64()), ("ends", pa.bool_())]))


def _starts(fragments: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys of all blocks, and the open string and depth at their start: a few bytes for each block of a file."""
    blocks = fragments.mapInArrow(_summaries, "path string, block long, string int, depth0 long, depth1 long, ends boolean")
    # A file's blocks, a row each.
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    states = blocks.withColumn("open", zero(F.sum("string").over(before)) % 2).withColumn(
        "added", F.when(F.col("open") == 0, F.col("depth0")).otherwise(F.col("depth1"))).withColumn(
        "depth", zero(F.sum("added").over(before)))
    last = F.lead("block").over(W.partitionBy("path").orderBy("block")).isNull()
    # No brace follows the end of the array, so the depth is one less there.
    whole = F.col("ends") & ((F.col("open") + F.col("string")) % 2 == 0) & (F.col("depth") + F.col("added") == -1)
    table = states.select("path", "block", "open", "depth", (last & ~whole).alias("broken")).toArrow()
    broken = [p for p, b in zip(table.column("path").to_pylist(), table.column("broken").to_pylist()) if b]
    if broken:
        raise ValueError(f"not a whole JSON array of objects: {sorted(broken)[:5]}")
    keys = np.array([_key(p, b) for p, b in zip(table.column("path").to_pylist(), table.column("block").to_pylist())], dtype=np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column("open").to_numpy()[order].astype(np.int8), table.column("depth").to_numpy()[order].astype(np.int32)


def _pieces(starts: tuple[np.ndarray, np.ndarray, np.ndarray]):
    keys, strings, depths = starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(kind: int, parts: list[str]) -> tuple:
            return path, block, first, kind, "".join(parts)

        def closed() -> list[tuple]:
            """What is left open at the end of a block."""
            return [row(_MIDDLE if begun else _TAIL, waiting)] if waiting else []

        at, waiting, begun, first, depth, string, n, path, block = None, [], False, 0, 0, 0, 0, None, None
        for new_path, new_block, values in _stretches(batches):
            found = []
            if (new_path, new_block) != at:
                found += closed()
                at, (path, block) = (new_path, new_block), (new_path, new_block)
                key = np.uint64(_key(path, block))
                i = int(np.searchsorted(keys, key))
                if i == len(keys) or keys[i] != key:
                    raise ValueError(f"the blocks of {path} changed while it was read")
                string, depth, waiting, n = int(strings[i]), int(depths[i]), [], 0
                begun, first = bool(string or depth), 0
            added, closes, after = _Fragments(values).run(string)
            level = depth + np.cumsum(added)
            before = np.concatenate([[depth], level[:-1]])
            for k, text in enumerate(values.to_pylist()):
                if not waiting:
                    first = n
                n += 1
                if not waiting and not begun and before[k] == 0 and level[k] == -1:
                    continue  # the end of the array, which was checked
                waiting.append(text + "}")
                if closes[k] and level[k] == 0:
                    found.append(row(_HEAD if begun else _WHOLE, waiting))
                    waiting, begun = [], False
            depth, string = int(level[-1]), int(after[-1])
            if found:
                yield batch_of(found)
        rest = closed()
        if rest:
            yield batch_of(rest)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["path", "block", "pos", "kind", "text"])

    return run


def array_objects(spark: SparkSession, path) -> DataFrame:
    """``text, seq``: the objects of files that each hold one JSON array of objects, and their order key.

    Two passes read the files, every block of them in a task of its own. A file that ends early raises, and so does one with
    elements that are no objects; an empty array has no rows. An object is held whole by one task, and the driver gets a few bytes for each block.
    """
    fragments = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    pieces = fragments.mapInArrow(_pieces(_starts(fragments)), "path string, block long, pos long, kind int, text string")
    whole = pieces.filter(F.col("kind") == _WHOLE)
    # Parts of objects that reach over blocks: at most two of a block.
    parts = pieces.filter(F.col("kind") != _WHOLE).withColumn("object", F.count_if(F.col("kind") == _TAIL).over(
        W.partitionBy("path").orderBy("block", "kind")))
    joined = parts.groupBy("path", "object").agg(
        F.min(F.struct("block", "pos")).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "").alias("text"),
    ).select("path", "at.block", "at.pos", "text")
    rows = whole.drop("kind").unionByName(joined)
    plain = F.regexp_replace("text", _BEFORE, "")
    wrong = F.raise_error(F.concat(F.lit("an element that is no object in "), F.col("path"))).cast("string")
    text = F.when(F.col("text").rlike(_BEFORE + r"\{"), plain).otherwise(wrong)
    return rows.select(text.alias("text"), F.struct("path", "block", "pos").alias("seq"))
