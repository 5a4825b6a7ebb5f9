"""Access-log files: scan, parse, parse statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.functions.text import LOG_LINE, log_time, stripped
from tracewarden.plans.ordering import scan_key
from tracewarden.schema import LOG_ENTRY


def log_scan(spark: SparkSession, path) -> DataFrame:
    """``(line, seq)`` for every line, blanks and comments included. Bad UTF-8 bytes are dropped."""
    dropped = F.replace(F.make_valid_utf8("value"), F.lit("�"), F.lit(""))
    # A replacement character that a valid line really holds stays.
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(dropped)
    return spark.read.text(path).select(text.alias("line"), scan_key().alias("seq"))


def _is_content(line: Column) -> Column:
    return (line != "") & ~F.startswith(line, F.lit("#"))


def parse_lines(lines: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """Parsed entries with their order key; lines that do not match are left out.

    The pattern runs once per line: it rewrites the line as ``\\n`` + the blank-free fields,
    the timestamp (which holds no ``]``), the referrer and the agent (which hold no quote).
    A stripped line never starts with ``\\n``, so that first character tells whether it matched.
    """
    rewritten = F.regexp_replace(
        stripped(F.col(line)), LOG_LINE + r"(?s:.*)$", "\n$1 $3 $4 $5 $6 $9 $2]$7\"$8"
    )
    # The one-element explode keeps filters and later projections above the regex: pushed below
    # it, each would repeat the whole rewriting. Comments and blank lines cannot match.
    cut = lines.select(order, F.explode(F.array(F.split(rewritten, " ", 7))).alias("_f")).filter(
        F.startswith(F.col("_f")[0], F.lit("\n")))
    f, rest = F.col("_f"), F.col("_f")[6]
    timestamp = F.substring_index(rest, "]", 1)
    tail = F.substr(rest, F.length(timestamp) + 2)
    number = lambda i: F.expr(f"try_cast(_f[{i}] AS BIGINT)")
    parsed = cut.select(
        F.substr(f[0], F.lit(2)).alias("ip"),
        timestamp.alias("timestamp"),
        f[1].alias("method"),
        f[2].alias("endpoint"),
        number(3).alias("status"),
        number(4).alias("bytes_sent"),
        F.substring_index(tail, '"', 1).alias("referrer"),
        F.substring_index(tail, '"', -1).alias("user_agent"),
        F.coalesce(number(5), F.lit(0)).cast("bigint").alias("response_time"),
        log_time(timestamp).alias("dt"),
        order,
    )
    assert parsed.columns[:-1] == LOG_ENTRY.names
    return parsed


def parse_stats(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row: total_lines, parsed_entries, parse_errors (content lines that do not match)."""
    text = lines.select(stripped(F.col(line)).alias("_line"))
    content = _is_content(F.col("_line"))
    match = F.rlike("_line", F.lit(LOG_LINE))
    return text.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(content & match).alias("parsed_entries"),
        F.count_if(content & ~match).alias("parse_errors"),
    )


def read_log(spark: SparkSession, path) -> DataFrame:
    return parse_lines(log_scan(spark, path))
