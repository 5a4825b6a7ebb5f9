"""Threats as files, JSON objects and a text report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.operators.stats import threat_summary

RULE = "=" * 60
THIN = "-" * 60


def write_threats(threats: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    threats.write.format(fmt).mode(mode).save(path)


def threat_json(threats: DataFrame) -> DataFrame:
    """One JSON object per threat with the six public fields."""
    fields = ["type", "severity", "source_ip", "description", "evidence", "timestamp"]
    return threats.select("rule_ord", "seq", F.to_json(F.struct(*fields)).alias("json"))


def threat_blocks(threats: DataFrame) -> DataFrame:
    """One text block per threat: headline, then up to three evidence items cut to 80 characters."""
    head = F.concat(
        F.lit("["), F.col("severity"), F.lit("] "), F.col("type"), F.lit(" from "),
        F.col("source_ip"), F.lit(": "), F.col("description"),
    )
    shown = F.transform(
        F.slice("evidence", 1, 3),
        lambda e: F.concat(F.lit("    Evidence: "), F.left(e, F.lit(80)), F.lit("...")),
    )
    return threats.select("rule_ord", "seq", F.array_join(F.concat(F.array(head), shown), "\n").alias("text"))


def threat_report(threats: DataFrame, statistics: DataFrame | None = None) -> DataFrame:
    """Text of the report in sections; write it with ``orderBy('section', 'rule_ord', 'seq', 'text')``.

    Sections: 0 head, 1 threats (each with an empty line after it), 2 and 3 statistics and their head, where there are any,
    4 the closing rule.
    """
    null_seq = F.lit(None).cast(threats.schema["seq"].dataType)
    s = threat_summary(threats).groupBy().pivot("metric", [
        "total_threats", "unique_attackers", "critical_count", "high_count", "medium_count", "low_count",
    ]).agg(F.max("value"))
    lines = [
        F.lit(RULE), F.lit("STATIC ANALYSIS DETECTION REPORT"), F.lit(RULE),
        F.format_string("Total Threats Detected: %d", "total_threats"),
        F.format_string("Unique Attackers: %d", "unique_attackers"),
        F.lit(""), F.lit("Threats by Severity:"),
        F.format_string("  CRITICAL: %d", "critical_count"),
        F.format_string("  HIGH: %d", "high_count"),
        F.format_string("  MEDIUM: %d", "medium_count"),
        F.format_string("  LOW: %d", "low_count"),
        F.lit(""), F.lit(THIN), F.lit("DETAILED THREATS:"), F.lit(THIN),
    ]
    header = s.select(
        F.lit(0).alias("section"), F.lit(0).alias("rule_ord"), null_seq.alias("seq"),
        F.array_join(F.array(*lines), "\n").alias("text"),
    )
    body = threat_blocks(threats).select(
        F.lit(1).alias("section"), "rule_ord", "seq", F.concat("text", F.lit("\n")).alias("text"))
    report = header.unionByName(body)
    part = lambda rows, section, text: rows.select(
        F.lit(section).alias("section"), F.lit(0).alias("rule_ord"), null_seq.alias("seq"), text.alias("text"))
    if statistics is not None:
        report = report.unionByName(part(statistics.limit(1), 2, F.lit(f"{THIN}\nSTATISTICS:\n{THIN}")))
        report = report.unionByName(part(statistics, 3, F.concat(
            F.lit("  "), F.concat_ws(" ", "metric", "key"), F.lit(": "), F.col("value").cast("string"))))
    return report.unionByName(part(threats.sparkSession.range(1), 4, F.lit(RULE)))
