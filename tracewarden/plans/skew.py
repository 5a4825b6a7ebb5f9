"""Lookups into a keyed table when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is split when it holds more rows than this, and more than 1/MAX_HOT of all rows.
HOT_ROWS = 1_000_000
#: Hence at most this many keys can be hot, which bounds the broadcast table.
MAX_HOT = 100_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys to split, with the number of parts for each. Never more than ``MAX_HOT`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return hot_of_counts(counts, keys, counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar(), hot_rows)


def hot_of_counts(counts: DataFrame, keys: list[str], total: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As :func:`hot_keys`, from known row counts ``_n`` per key and the total number of rows."""
    limit = F.greatest(F.lit(hot_rows), F.floor(total / MAX_HOT))
    return counts.filter(F.col("_n") > limit).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"),
    )


def split_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
    total: int | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (one row per key), spreading hot keys over several tasks.

    The rows of a hot key are dealt to parts by a hash of ``spread_on``, or by their number where rows of a key may be equal
    in all columns (``spread_on`` empty); the one lookup row of that
    key is copied once per part. Other keys join as usual. Pass ``hot`` to reuse a table of hot keys,
    and ``total`` if the number of rows is known: with at most ``hot_rows`` of them no key is hot.
    """
    if total is not None and total <= hot_rows:
        return rows.join(lookup, keys, how)
    hot = hot_keys(rows, keys, hot_rows) if hot is None else hot
    hot = F.broadcast(hot)

    def with_parts(df: DataFrame) -> DataFrame:
        match = [df[k].eqNullSafe(hot[f"_hot_{k}"]) for k in keys]
        return (
            df.join(hot, match, "left")
            .withColumn("_parts", F.coalesce("_parts", F.lit(1)))
            .drop(*[f"_hot_{k}" for k in keys])
        )

    spread = F.xxhash64(*spread_on) if spread_on else F.monotonically_increasing_id()
    left = with_parts(rows).withColumn(
        "_part", F.pmod(spread, F.col("_parts").cast("bigint")).cast("int")
    ).drop("_parts")
    right = with_parts(lookup).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).drop("_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


#: A table of keys is broadcast only after it was counted and is within both limits.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def rows_of_keys(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys occur in ``groups``, a stored table with one row per key.

    A small table is broadcast, so that only the matching rows go on. Beyond the limits the join
    shuffles, with hot keys split.
    """
    width = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(0))
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    side = groups.select(*keys)
    if size["n"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(side), keys, "left_semi")
    return split_join(rows, side, keys, [c for c in rows.columns if c not in keys], "left_semi")
