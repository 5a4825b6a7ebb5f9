"""Summaries in long form ``(metric, key, value)``: any number of keys, no row that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.functions.text import trimmed_path
from tracewarden.operators.entries import frequency, top_n


def _long(df: DataFrame, metric: str, key: str, value: str) -> DataFrame:
    return df.select(
        F.lit(metric).alias("metric"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("double").alias("value"),
    )


def _unpivot(one_row: DataFrame) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value"))
        for c in one_row.columns
    ])
    return one_row.select(F.inline(pairs))


def _union(parts) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def log_summary(entries: DataFrame) -> DataFrame:
    """Totals, status and method distribution, ten most active addresses. No rows for no entries."""
    totals = entries.agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.count_distinct("ip").alias("unique_ips"),
        F.count_distinct("endpoint").alias("unique_endpoints"),
    ).filter(F.col("total_entries") > 0)
    return _union([
        _unpivot(totals),
        _long(frequency(entries, "status"), "status", "status", "count"),
        _long(frequency(entries, "method"), "method", "method", "count"),
        _long(top_n(frequency(entries, "ip"), "ip", 10), "top_ip", "ip", "count"),
    ])


def access_graph_statistics(entries: DataFrame) -> DataFrame:
    """Statistics of the address → endpoint graph in closed form.

    Edges only leave addresses, so each address starts one directed component and endpoints have
    out-degree 0. An endpoint that is itself an address would break this; endpoints start with ``/``.
    """
    pairs = entries.groupBy("ip", "endpoint").agg(F.count(F.lit(1)).alias("n"))
    per_ip = pairs.groupBy("ip").agg(F.count(F.lit(1)).alias("degree"), F.sum("n").alias("n"))
    endpoints = entries.agg(F.count_distinct("endpoint").alias("n")).scalar()
    return per_ip.agg(
        (F.count(F.lit(1)) + endpoints).alias("nodes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("edges"),
        (F.sum("degree") / (F.count(F.lit(1)) + endpoints)).alias("avg_degree"),
        F.max("degree").alias("max_degree"),
        F.lit(0).alias("min_degree"),
        F.count(F.lit(1)).alias("components"),
    ).filter(F.col("edges") > 0)


def log_statistics(entries: DataFrame) -> DataFrame:
    """As :func:`log_summary`, but with trimmed endpoints, graph statistics and five addresses."""
    totals = entries.agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.count_distinct("ip").alias("unique_ips"),
        F.count_distinct(trimmed_path(F.col("endpoint"))).alias("unique_endpoints"),
    ).filter(F.col("total_entries") > 0)
    graph = access_graph_statistics(entries)
    return _union([
        _unpivot(totals),
        _unpivot(graph.select(*[F.col(c).alias(f"graph_{c}") for c in graph.columns])),
        _long(frequency(entries, "status"), "status", "status", "count"),
        _long(frequency(entries, "method"), "method", "method", "count"),
        _long(top_n(frequency(entries, "ip"), "ip", 5), "top_ip", "ip", "count"),
    ])


def threat_summary(threats: DataFrame) -> DataFrame:
    """``(metric, value)``: totals, distinct source texts, counts per severity and per type."""
    # One pass over the threats; totals and types are both taken from these counts.
    counts = threats.groupBy("type", "severity", "source_ip").agg(F.count(F.lit(1)).alias("n"))
    number = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    totals = counts.agg(
        number("n").alias("total_threats"),
        F.count_distinct("source_ip").alias("unique_attackers"),
        *[number(F.when(F.col("severity") == s, F.col("n"))).alias(f"{s.lower()}_count")
          for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
    )
    named = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in totals.columns
    ])
    per_type = counts.groupBy("type").agg(F.sum("n").alias("value"))
    return totals.select(F.inline(named)).unionByName(
        per_type.select(F.concat(F.lit("type_"), F.col("type")).alias("metric"), "value"))


def unique_attackers(threats: DataFrame) -> DataFrame:
    return threats.select("source_ip").distinct()


def flow_totals(packets: DataFrame) -> DataFrame:
    return packets.groupBy("src_ip", "dst_ip").agg(F.sum("size").alias("bytes"))


def traffic_dashboard(packets: DataFrame, recent: int = 1000) -> DataFrame:
    """The dashboard's packet counter stops at ``recent``; the true count stands beside it."""
    return packets.agg(
        F.least(F.count(F.lit(1)), F.lit(recent)).cast("bigint").alias("packets_shown"),
        F.count(F.lit(1)).alias("packets"),
        F.count_distinct("src_ip").alias("unique_ips"),
    )
