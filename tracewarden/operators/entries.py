"""Filters, projections and plain counts over parsed log entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.functions.text import entry_line, second_of


def by_ip(entries: DataFrame, ip: str) -> DataFrame:
    return entries.filter(F.col("ip") == ip)


def by_status(entries: DataFrame, status: int) -> DataFrame:
    return entries.filter(F.col("status") == status)


def by_method(entries: DataFrame, method: str) -> DataFrame:
    return entries.filter(F.upper("method") == method.upper())


def rendered(entries: DataFrame, order: str = "seq") -> DataFrame:
    """The one-line form and the JSON form (which leaves out the parsed time)."""
    fields = ["ip", "timestamp", "method", "endpoint", "status", "bytes_sent",
              "referrer", "user_agent", "response_time"]
    return entries.select(order, entry_line().alias("line"), F.to_json(F.struct(*fields)).alias("json"))


def failed_logins(entries: DataFrame) -> DataFrame:
    return entries.filter((F.col("status") == 401) & F.contains(F.lower("endpoint"), F.lit("login")))


def with_failed_flag(entries: DataFrame) -> DataFrame:
    """``failed_login`` looks at the status alone, unlike :func:`failed_logins`."""
    return entries.withColumn("failed_login", F.when(F.col("status") == 401, 1).otherwise(0))


def unique(entries: DataFrame, column: str) -> DataFrame:
    return entries.select(column).distinct()


def frequency(entries: DataFrame, column: str) -> DataFrame:
    return entries.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def top_n(counts: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Largest counts first; equal counts by key."""
    return counts.orderBy(F.desc("count"), key).limit(n)


def requests_per_second(entries: DataFrame) -> DataFrame:
    timed = entries.filter(F.col("dt").isNotNull())
    return timed.groupBy(second_of(F.col("dt")).alias("second")).agg(F.count(F.lit(1)).alias("requests"))
