"""The whole log analysis: file to threats, statistics and summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.operators.rules import detect_all
from tracewarden.operators.stats import log_statistics, threat_summary
from tracewarden.session import written_table
from tracewarden.sources.logs import log_scan, parse_lines, parse_stats


@dataclass
class Analysis:
    """``message`` is set, and the tables are empty, when there was nothing to analyse."""

    threats: DataFrame
    summary: DataFrame
    statistics: DataFrame
    message: str | None = None


def analyze(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> Analysis:
    """``entries`` is read once per rule: pass a stored table rather than a parse of raw text."""
    threats = written_table(detect_all(entries, cfg), "threats")
    message = "No entries to analyze" if entries.isEmpty() else None
    return Analysis(threats, threat_summary(threats), log_statistics(entries), message)


def run_static_analysis(spark: SparkSession, path, cfg: DetectionConfig = DEFAULTS) -> Analysis:
    lines = log_scan(spark, path)
    entries = written_table(parse_lines(lines), "entries")
    result = analyze(entries, cfg)
    counts = parse_stats(lines)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value"))
        for c in counts.columns
    ])
    result.statistics = result.statistics.unionByName(counts.select(F.inline(pairs)))
    if result.message:
        result.message = f"Failed to parse log file: {path}"
    return result
