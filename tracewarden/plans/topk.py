"""First-k per group. The row_number filter becomes a group limit before and after the exchange,
so a group of any size sends at most k rows per task and is never collected whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def first_k(df: DataFrame, keys, order: str, value: Column, k: int, name: str) -> DataFrame:
    """``keys`` and the array of ``value`` over the first ``k`` rows in ``order``."""
    w = W.partitionBy(*keys).orderBy("_o")
    cut = (
        df.select(*keys, F.col(order).alias("_o"), value.alias("_v"))
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= k)
    )
    return cut.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_v"))), lambda s: s["_v"]).alias(name)
    )


def k_smallest(df: DataFrame, keys, item: str, k: int, name: str) -> DataFrame:
    """``keys`` and the sorted array of the ``k`` smallest distinct values of ``item``."""
    pairs = df.select(*keys, F.col(item).alias("_i")).distinct()
    return first_k(pairs, keys, "_i", F.col("_i"), k, name)
