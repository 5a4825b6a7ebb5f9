"""Substring dedup by seed and extend: winnowed anchors, extension both ways, maximal repeats.

*Seed.* Every window of ``width`` words names one anchor: its gram of ``GRAM`` words with the smallest hash
(the leftmost of equals). Equal windows name equal anchors at the same place, so whatever
repeats meets on an anchor. Consecutive windows with one anchor are a segment, one row with the anchor's hash
and the hash of all words that the segment's windows cover: one row for about fifteen words.

*Extend.* An anchor that occurs once has no repeats. Where all its segments have the same words, the match extends over them whole.
Where they differ, each different segment (once, however often it occurs) extends window by window, as far as
hashes of windows agree. No pairs of occurrences are made: an anchor with n occurrences costs n rows.

*Maximal repeats.* The repeated windows of a text are merged to spans, as long as they go.

Texts are known by a 128-bit hash of their content, so copies share their work and rows need no unique
id. Window equality is judged on 64-bit hashes within the windows that share a 64-bit anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.words import SLICE_ROWS, RollingHash, free_name, hashes_of, per_document, texts
from tracewarden.plans.skew import rows_of_keys
from tracewarden.session import written_table

WIDTH = 35
GRAM = 6
#: Windows whose anchors are sought at once; bounds the memory that a long text takes.
CHUNK = 1 << 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """Rolling hashes are sums; scramble them, so that order and equality mean nothing but chance."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments(words: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchor, content, start, windows`` of the segments of a text."""
    gram = min(GRAM, width)
    n = len(words) - width + 1
    if n <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    rolling = RollingHash(hashes_of(words))
    grams = _mixed(rolling.windows(gram))
    view = np.lib.stride_tricks.sliding_window_view(grams, width - gram + 1)
    anchors = np.concatenate([view[at:at + CHUNK].argmin(axis=1) + np.arange(at, min(at + CHUNK, n))
                              for at in range(0, n, CHUNK)])
    first = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
    last = np.concatenate([first[1:], [n]])
    place = (anchors[first] - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
    content = _mixed(_mixed(rolling.run(first, last + width - 1)) + place)
    return grams[anchors[first]], content, first, last - first


def _long(array: np.ndarray) -> pa.Array:
    return pa.array(array.view(np.int64) if array.dtype == np.uint64 else array)


def _keyed(docs: DataFrame, name: str = "__key") -> DataFrame:
    """``docs`` with the key of the text, null as empty."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn(name, F.unhex(digest))


def _seeds(docs: DataFrame, width: int) -> DataFrame:
    """``key, anchor, content, start, windows`` for all segments of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part.slice(at, SLICE_ROWS) for part in batches for at in range(0, part.num_rows, SLICE_ROWS)):
            parts, counts = [], []
            for text in texts(batch):
                found = segments((text or b"").split(), width)
                counts.append(len(found[0]))
                if counts[-1]:
                    parts.append(found)
            if parts:
                which = pa.array(np.repeat(np.arange(len(counts)), counts))
                columns = [_long(np.concatenate([p[k] for p in parts])) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(which), *columns], ["key", "anchor", "content", "start", "windows"])

    keyed = _keyed(docs.select("text")).select(F.col("__key").alias("key"), "text")
    return keyed.mapInArrow(run, "key binary, anchor bigint, content bigint, start bigint, windows bigint")


def _windows(out: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if out[0]:
        yield pa.RecordBatch.from_arrays([_long(np.concatenate(x)) for x in out], ["anchor", "content", "place", "window"])


def _extended(docs: DataFrame, unlike: DataFrame, width: int) -> DataFrame:
    """``anchor, content, place, window``: the windows of one occurrence of each segment of ``unlike``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, rows = [[], [], [], []], 0
            for text, wanted in zip(texts(batch), batch.column(1)):
                hashes = RollingHash(hashes_of(text.split())).windows(width)
                if rows >= CHUNK:
                    yield from _windows(out)
                    out, rows = [[], [], [], []], 0
                for s in wanted.as_py():
                    rows += s["windows"]
                    some = _mixed(hashes[s["start"]:s["start"] + s["windows"]])
                    out[0].append(np.full(len(some), s["anchor"], dtype=np.int64))
                    out[1].append(np.full(len(some), s["content"], dtype=np.int64))
                    out[2].append(np.arange(len(some)))
                    out[3].append(some)
            yield from _windows(out)

    wanted = unlike.groupBy(F.col("at.key").alias("__key")).agg(
        F.collect_list(F.struct("anchor", "content", "at.start", "windows")).alias("wanted"))
    wanted = written_table(wanted, "repeats-wanted")
    some = rows_of_keys(_keyed(docs.select("text")), wanted, ["__key"])
    # One row per text: the copies of a text would say the same.
    one = some.dropDuplicates(["__key"]).join(wanted, "__key").select("text", "wanted")
    return one.mapInArrow(run, "anchor bigint, content bigint, place bigint, window bigint")


def _marks(docs: DataFrame, width: int) -> DataFrame:
    """``__key, __marks``: per text its segments with repeated windows, as (start, bits of windows)."""
    seeds = written_table(_seeds(docs, width), "repeats-seeds")
    anchors = seeds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
    again = anchors.filter("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("unlike"))
    met = written_table(seeds.join(again, "anchor"), "repeats-met")
    kinds = written_table(met.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "start")).alias("at"),
        F.max("windows").alias("windows"), F.max("unlike").alias("unlike")), "repeats-kinds")
    windows = written_table(_extended(docs, kinds.filter("unlike"), width), "repeats-windows")
    # A window repeats if it lies in two different segments, or in a segment that repeats.
    same = windows.groupBy("anchor", "window").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    partly = windows.join(same.filter("a != b").select("anchor", "window"), ["anchor", "window"]).groupBy(
        "anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, int(place))")).alias("bits"))
    whole = kinds.filter("n > 1").select(
        "anchor", "content", F.expr("shiftleft(1L, int(windows)) - 1").alias("bits"))
    # A window of a segment that occurs once may also lie in a segment that repeats: that is two segments, too.
    bits = whole.unionByName(partly).groupBy("anchor", "content").agg(F.bit_or("bits").alias("bits"))
    marked = met.join(bits, ["anchor", "content"]).select("key", F.struct("start", "bits").alias("mark"))
    return marked.groupBy(F.col("key").alias("__key")).agg(F.collect_set("mark").alias("__marks"))


def _covered(n: int, marks: list[dict], width: int) -> np.ndarray:
    """A flag per word: is it in a repeated window?"""
    change = np.zeros(n + 1, dtype=np.int64)
    for m in marks:
        bits, at = m["bits"], m["start"]
        while bits:
            low = bits & -bits
            start = at + low.bit_length() - 1
            change[start] += 1
            change[start + width] -= 1
            bits ^= low
    return np.cumsum(change[:n]) > 0


def remove_repeats(docs: DataFrame, width: int = WIDTH, name: str = "repeats") -> DataFrame:
    """``docs`` (any columns, among them ``text``) with a column ``name``:
    ``struct<n_words, n_removed, kept, spans>``.

    A word goes if a window of ``width`` consecutive words of its text covers it that also starts
    anywhere else, in the same text, a copy or another text; all its occurrences go. ``kept`` joins the
    other words with one space; ``spans`` are the maximal repeats as word positions ``[start, end)``. Windows are judged on
    the input. Null and empty texts have no words; texts shorter than a window keep all words; repeated rows repeat each other and
    so lose their words; an empty table gives no rows. A column of ``docs`` of the result's name is replaced.
    """
    assert 1 <= width <= 62
    names = [c for c in docs.columns if c != name]
    docs = docs.select(*names)
    key, marked = free_name(docs, "key"), free_name(docs, "marks")
    marks = _marks(docs, width).withColumnsRenamed({"__key": key, "__marks": marked})
    joined = _keyed(docs, key).join(marks, key, "left").drop(key)

    def make(batch: pa.RecordBatch) -> dict:
        counts, removed, kept, spans = [], [], [], []
        for text, marks in zip(texts(batch), batch.column(batch.num_columns - 1)):
            words, marks = (text or b"").split(), marks.as_py()
            runs = []
            if marks:
                gone = _covered(len(words), marks, width)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                runs = [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                left = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                left = words
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
            spans.append(runs)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {name: pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept), pa.array(spans, kind)],
            ["n_words", "n_removed", "kept", "spans"])}

    result = per_document(joined, [*names, marked], (
        f"`{name}` struct<n_words: bigint, n_removed: bigint, kept: string, spans: array<struct<start: bigint, end: bigint>>>"
    ), make)
    return result.drop(marked)


def keep_unrepeated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without their repeated passages, with their columns: a text that loses words becomes the rest of its words (and ``n_chars``, where
    there is one, its length); a text that loses all its words goes. Other rows stay as they are."""
    name = free_name(docs, "repeats")
    found = remove_repeats(docs, width, name)
    lost = F.col(f"{name}.n_removed") > 0
    found = found.filter(~lost | (F.col(f"{name}.n_removed") < F.col(f"{name}.n_words")))
    text = F.when(lost, F.col(f"{name}.kept")).otherwise(F.col("text"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(lost, F.length(f"{name}.kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.withColumn("text", text).select(*docs.columns)
