"""Path-prefix operators over a table of counted prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.functions.patterns import SUSPICIOUS_PATH_PARTS
from tracewarden.functions.text import contains_any, normal_path, path_tokens, trimmed_path
from tracewarden.plans.skew import split_join


def prefix_counts(paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """``prefix, depth, count, is_end`` for every non-empty prefix, without outer slashes.

    Equal paths are added up before they are cut into prefixes, so the explode works on distinct
    paths, and a hot path is one row. Segments hold no slash, so the joined text is unambiguous.
    """
    distinct = paths.groupBy(trimmed_path(F.col(path)).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    tokens = distinct.filter(F.col("_p") != "").select("_n", F.split("_p", "/").alias("_t"))
    cut = tokens.select("_n", "_t", F.explode(F.sequence(F.lit(1), F.size("_t"))).alias("depth"))
    return (
        cut.select(
            F.array_join(F.slice("_t", F.lit(1), F.col("depth")), "/").alias("prefix"),
            "depth", "_n", (F.col("depth") == F.size("_t")).alias("_end"),
        )
        .groupBy("prefix", "depth")
        .agg(F.sum("_n").alias("count"), F.max("_end").alias("is_end"))
    )


def _distinct_trimmed(paths: DataFrame, path: str) -> DataFrame:
    return paths.select(trimmed_path(F.col(path)).alias("_trimmed")).distinct()


def _probe(probes: DataFrame, table: DataFrame) -> DataFrame:
    keyed = probes.withColumn("_trimmed", trimmed_path(F.col("probe")))
    # Equal probes have equal keys, so they are spread by their number.
    return split_join(keyed, table, ["_trimmed"], [], "left").drop("_trimmed")


def search(probes: DataFrame, paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """``probes(probe, ...)`` with ``found``: the probe is a whole path of the data."""
    known = _distinct_trimmed(paths, path).withColumn("_hit", F.lit(True))
    return _probe(probes, known).select(
        *probes.columns, F.coalesce("_hit", F.lit(False)).alias("found"))


def starts_with(probes: DataFrame, paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """``found``: some path has the probe's segments as a prefix; the empty probe always has."""
    known = prefix_counts(paths, path).select(F.col("prefix").alias("_trimmed"), F.lit(True).alias("_hit"))
    root = trimmed_path(F.col("probe")) == ""
    return _probe(probes, known).select(
        *probes.columns, (root | F.coalesce("_hit", F.lit(False))).alias("found"))


def get_count(probes: DataFrame, paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """``count`` of paths through the probe's prefix; 0 if absent, and 0 for the root."""
    known = prefix_counts(paths, path).select(F.col("prefix").alias("_trimmed"), "count")
    return _probe(probes, known).select(
        *probes.columns, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def all_paths(paths: DataFrame, path: str = "endpoint") -> DataFrame:
    return paths.select(normal_path(F.col(path)).alias("path")).distinct()


def suspicious(paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """Distinct paths with a suspicious part: plain substrings, case-sensitive."""
    return all_paths(paths.filter(contains_any(F.col(path), SUSPICIOUS_PATH_PARTS)), path)


def depth_distribution(paths: DataFrame, path: str = "endpoint") -> DataFrame:
    """Distinct paths per number of segments; the root has depth 0."""
    return (
        all_paths(paths, path)
        .groupBy(F.size(path_tokens(F.col("path"))).alias("depth"))
        .agg(F.count(F.lit(1)).alias("paths"))
    )


def path_data(paths: DataFrame, data: Column, order: str, path: str = "endpoint") -> DataFrame:
    """``path, data, insertions``: the data written last with each path."""
    return paths.groupBy(normal_path(F.col(path)).alias("path")).agg(
        F.max_by(data, F.col(order)).alias("data"), F.count(F.lit(1)).alias("insertions"))
