"""Running values in row order without a single-task window.

``Window.partitionBy(key).orderBy(order)`` sorts all rows of a key in one task, and a global order
sorts everything in one task. Here rows are cut into chunks of bounded size. What each chunk must
know about the chunks before it is a small aggregate (partial sums combine map-side); it enters the
chunk as one leading *carry* row, so a plain window inside the chunk gives the global answer.

All specs of one call share one exchange of the rows, on the chunk. It has more tasks where there are more chunks, since a task
sorts all that it holds once for each set of keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewarden.plans.ordering import CHUNK_ROWS, Chunks, chunks_of


@dataclass(frozen=True)
class RunningSum:
    """Sum of ``value`` over this row and all earlier rows with the same keys."""

    name: str
    keys: tuple[str, ...]
    value: Column


@dataclass(frozen=True)
class RunningDistinct:
    """Distinct values of column ``item`` seen so far among rows with the same keys."""

    name: str
    keys: tuple[str, ...]
    item: str


@dataclass(frozen=True)
class Previous:
    """Last non-null ``value`` among earlier rows with the same keys."""

    name: str
    keys: tuple[str, ...]
    value: Column


_EARLIER = (W.unboundedPreceding, -1)


def _total(name: str, w) -> Column:
    return F.coalesce(F.sum(name).over(w), F.lit(0))


def _last(name: str, w) -> Column:
    return F.last(name, ignorenulls=True).over(w)


def _per_chunk(sums, lasts, order: str) -> list[Column]:
    return [*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums],
            *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(order))).alias(n) for n in lasts]]


def _before_all(source: DataFrame, order: str, chunks: Chunks, sums, lasts) -> DataFrame:
    """Per chunk, sums and last values over all earlier chunks."""
    per_chunk = source.groupBy("_chunk").agg(*_per_chunk(sums, lasts, order))
    grouped = per_chunk.withColumn("_group", chunks.group(F.col("_chunk")))
    inside = W.partitionBy("_group").orderBy("_chunk").rowsBetween(*_EARLIER)
    # One row per group of chunks: a few thousand rows even for trillions of packets.
    across = W.orderBy("_group").rowsBetween(*_EARLIER)
    known = lambda n: F.when(F.col(n).isNotNull(), F.col("_chunk"))
    base = grouped.groupBy("_group").agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max_by(n, known(n)).alias(n) for n in lasts]
    ).select(
        "_group",
        *[_total(n, across).alias(f"_base_{n}") for n in sums],
        *[_last(n, across).alias(f"_base_{n}") for n in lasts],
    )
    local = grouped.select(
        "_group", "_chunk", *[_total(n, inside).alias(n) for n in sums], *[_last(n, inside).alias(n) for n in lasts])
    return local.join(base, "_group").select(
        "_chunk",
        *[(F.col(n) + F.col(f"_base_{n}")).alias(n) for n in sums],
        *[F.coalesce(n, f"_base_{n}").alias(n) for n in lasts],
    )


def _exchanged(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)


def _before_keys(source: DataFrame, order: str, sets, tasks: int | None = None) -> DataFrame:
    """Per chunk and key, sums and last values over all earlier chunks; one aggregate for all sets of keys, ``(keys, sums, lasts)``."""
    columns = list(dict.fromkeys(k for keys, _, _ in sets for k in keys))
    sums, lasts = [n for s in sets for n in s[1]], [n for s in sets for n in s[2]]
    if len(sets) == 1:
        per_chunk = source.groupBy(*columns, "_chunk").agg(*_per_chunk(sums, lasts, order))
        w = W.partitionBy(*columns).orderBy("_chunk").rowsBetween(*_EARLIER)
        owned = lambda n, value: value
    else:
        per_chunk = source.groupingSets([[*keys, "_chunk"] for keys, _, _ in sets], *columns, "_chunk").agg(
            F.grouping_id().alias("_set"), *_per_chunk(sums, lasts, order))
        w = W.partitionBy("_set", *columns).orderBy("_chunk").rowsBetween(*_EARLIER)
        # The number of a set has a bit for each column that it lacks; the last column is in all.
        bit = {c: 2 << i for i, c in enumerate(reversed(columns))}
        number = {n: sum(b for c, b in bit.items() if c not in keys) for keys, a, b_ in sets for n in (*a, *b_)}
        owned = lambda n, value: F.when(F.col("_set") == number[n], value)
    if tasks is not None:
        # In place of the exchange that the window makes.
        per_chunk = _exchanged(per_chunk, tasks, *(c for c in per_chunk.columns if c in ("_set", *columns)))
    return per_chunk.select(
        *columns, "_chunk", *[owned(n, _total(n, w)).alias(n) for n in sums], *[owned(n, _last(n, w)).alias(n) for n in lasts])


def _by_keys(specs):
    ordered = sorted(specs, key=lambda s: s.keys)
    return [(keys, list(group)) for keys, group in groupby(ordered, key=lambda s: s.keys)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_running(df: DataFrame, order: str, specs, width: int = CHUNK_ROWS, chunks: Chunks | None = None) -> DataFrame:
    """Add one column per spec. ``order`` must be unique per row. ``chunks`` spares a look at its values."""
    chunks = chunks or chunks_of(df, order, width)
    tasks = chunks.tasks(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sums = [s for s in specs if isinstance(s, RunningSum)]
    distincts = [s for s in specs if isinstance(s, RunningDistinct)]
    lasts = [s for s in specs if isinstance(s, Previous)]

    rows = df.select(
        "*",
        chunks.of(F.col(order)).alias("_chunk"),
        F.lit(2).alias("_rank"),
        *[s.value.alias(f"_in_{s.name}") for s in [*sums, *lasts]],
    )
    # One +1 at the first row of each (keys, item); it enters the scan just before that row.
    firsts = {}
    for s in distincts:
        first = rows.groupBy(*s.keys, s.item).agg(F.min(order).alias(order))
        firsts[s.name] = first.select(
            *s.keys, order, chunks.of(F.col(order)).alias("_chunk"), F.lit(1).cast("bigint").alias(f"_in_{s.name}"))
    parts = [rows, *[f.withColumn("_rank", F.lit(1)) for f in firsts.values()]]
    sets = []
    for keys, group in _by_keys(specs):
        added = [f"_in_{s.name}" for s in group if not isinstance(s, Previous)]
        kept = [f"_in_{s.name}" for s in group if isinstance(s, Previous)]
        if keys:
            sets.append((keys, added, kept))
        else:
            own = [firsts[s.name] for s in group if s.name in firsts]
            inputs = [n for n in (*added, *kept) if n in rows.columns]
            source = _union([rows.select(order, "_chunk", *inputs), *own])
            parts.append(_before_all(source, order, chunks, added, kept).withColumn("_rank", F.lit(0)))
    if sets:
        columns = list(dict.fromkeys(k for keys, _, _ in sets for k in keys))
        inputs = [n for _, a, b in sets for n in (*a, *b) if n in rows.columns]
        own = [firsts[s.name] for s in distincts if s.keys]
        source = _union([rows.select(*columns, order, "_chunk", *inputs), *own])
        parts.append(_before_keys(source, order, sets, tasks).withColumn("_rank", F.lit(0)))

    merged = _exchanged(_union(parts), tasks, "_chunk")

    def frame(keys):
        # Carry rows have a null order key and so come first.
        return W.partitionBy("_chunk", *keys).orderBy(F.col(order).asc_nulls_first(), "_rank")

    outputs = [
        F.sum(f"_in_{s.name}").over(frame(s.keys).rowsBetween(W.unboundedPreceding, 0)).alias(s.name)
        for s in [*sums, *distincts]
    ] + [
        F.last(f"_in_{s.name}", ignorenulls=True)
        .over(frame(s.keys).rowsBetween(W.unboundedPreceding, -1)).alias(s.name)
        for s in lasts
    ]
    return (
        merged.select(*df.columns, "_rank", *outputs)
        .filter(F.col("_rank") == 2)
        .drop("_rank")
    )


def with_row_number(df: DataFrame, order: str, name: str, width: int = CHUNK_ROWS) -> DataFrame:
    """Dense 1-based numbers in ``order``, computed chunk by chunk."""
    return with_running(df, order, [RunningSum(name, (), F.lit(1).cast("bigint"))], width)
