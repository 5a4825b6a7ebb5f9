"""Counts over a trailing time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Buckets of time in a second: a power of two, so that dividing a time by a bucket's width rounds nothing.
BUCKETS_A_SECOND = 4


def trailing_counts(df: DataFrame, keys: list[str], time: str, seconds: int, **extra) -> DataFrame:
    """Per (keys, time): ``in_window``, the rows with the same keys in ``[time - seconds, time]``, and
    ``at_time``, those at the very time. ``seconds`` is a whole number.

    Rows with equal time are added up before the exchange. A window covers whole buckets of time but for the two at its
    ends. The whole ones are sums of bucket totals; exact counts are made of the bucket that the time is in and the one that its
    window begins in. So a task holds the distinct times of two buckets of a key, and at most two windows' buckets of totals,
    however many rows a key has.
    """
    counts = df.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in extra.items()]
    )
    width = seconds * BUCKETS_A_SECOND
    counts = counts.withColumn("_home", F.floor(F.col(time) * BUCKETS_A_SECOND))
    totals = counts.groupBy(*keys, "_home").agg(F.sum("_n").alias("_n")).withColumn(
        "_stretch", F.explode(F.array(F.floor(F.col("_home") / width), F.floor(F.col("_home") / width) + 1)))
    w = W.partitionBy(*keys, "_stretch").orderBy("_home").rangeBetween(1 - width, -1)
    whole = totals.withColumn("_whole", F.coalesce(F.sum("_n").over(w), F.lit(0))).filter(
        F.col("_stretch") == F.floor(F.col("_home") / width)).select(*keys, F.col("_home").alias("_bucket"), "_whole")
    placed = counts.withColumn("_bucket", F.explode(F.array(F.col("_home"), F.col("_home") + width)))
    rows = placed.unionByName(whole, allowMissingColumns=True)
    bucket = W.partitionBy(*keys, "_bucket")
    # The row of the whole buckets has no time, which puts it outside the frames of those that have one.
    edges = F.sum("_n").over(bucket.orderBy(time).rangeBetween(-seconds, 0))
    return (
        rows.withColumn("in_window", edges + F.max("_whole").over(
            bucket.orderBy(time).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .filter(F.col("_home") == F.col("_bucket"))
        .withColumnRenamed("_n", "at_time")
        .drop("_home", "_bucket", "_whole")
    )
