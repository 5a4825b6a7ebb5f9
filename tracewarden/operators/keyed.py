"""Keyed maps as tables ``(key, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.plans.skew import split_join


def increment(df: DataFrame, key: str, amount: Column | None = None) -> DataFrame:
    """Sum of amounts per key; an amount of 1 unless given."""
    value = F.lit(1) if amount is None else amount
    return df.groupBy(F.col(key).alias("key")).agg(F.sum(value).cast("bigint").alias("value"))


def upsert(df: DataFrame, key: str, value: Column, order: str) -> DataFrame:
    """The last value written per key."""
    return df.groupBy(F.col(key).alias("key")).agg(F.max_by(value, F.col(order)).alias("value"))


def _spread(probes: DataFrame) -> list[str]:
    return [c for c in probes.columns if c != "key"]


def lookup(probes: DataFrame, table: DataFrame) -> DataFrame:
    """``probes(key, ...)`` with the value of each key, NULL where the key is missing."""
    return split_join(probes, table, ["key"], _spread(probes), "left")


def contains(probes: DataFrame, table: DataFrame) -> DataFrame:
    """Probes whose key is present with a value that is not NULL."""
    present = table.filter(F.col("value").isNotNull()).select("key")
    return split_join(probes, present, ["key"], _spread(probes), "left_semi")


def remove(table: DataFrame, keys: DataFrame) -> DataFrame:
    return split_join(table, keys.select("key").distinct(), ["key"], _spread(table), "left_anti")


def keys(table: DataFrame) -> DataFrame:
    return table.select("key")


def values(table: DataFrame) -> DataFrame:
    return table.select("value")


def items(table: DataFrame) -> DataFrame:
    return table.select("key", "value")
