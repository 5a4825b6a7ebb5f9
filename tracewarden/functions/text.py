"""Text expressions: log lines, paths, severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\f\x0b"

#: Fixed value: the combined log format, anchored at the start only. Groups: ip, timestamp,
#: method, endpoint, status, bytes, referrer, user agent, response time (optional).
LOG_LINE = (
    r'^([\d.]+)\s+-\s+-\s+\[([^\]]+)\]\s+"(\w+)\s+(\S+)\s+HTTP/[\d.]+"\s+'
    r'(\d+)\s+(\d+)\s+"([^"]*)"\s+"([^"]*)"\s*(\d+)?'
)

SEVERITIES = ("low", "medium", "high", "critical")


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def log_time(text: Column) -> Column:
    """Local wall-clock time of a log timestamp; the offset is ignored, junk gives NULL."""
    first = F.split(stripped(text), " ")[0]
    return F.try_to_timestamp(first, F.lit("d/MMM/yyyy:H:m:s")).cast("timestamp_ntz")


def second_of(dt: Column) -> Column:
    return F.date_format(dt, "yyyy-MM-dd HH:mm:ss")


def trimmed_path(path: Column) -> Column:
    return F.btrim(path, F.lit("/"))


def path_tokens(path: Column) -> Column:
    """Segments of a path; outer slashes are dropped, inner empty segments are kept."""
    inner = trimmed_path(path)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "/"))


def normal_path(path: Column) -> Column:
    return F.concat(F.lit("/"), trimmed_path(path))


def contains_any(text: Column, words) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def severity_rank(severity: Column) -> Column:
    """critical 3, high 2, medium 1, low and anything else 0; case does not matter."""
    lowered = F.lower(severity)
    return (
        F.when(lowered == "critical", 3).when(lowered == "high", 2)
        .when(lowered == "medium", 1).otherwise(0)
    )


def entry_line(prefix: str = "") -> Column:
    """A parsed entry as ``ip [timestamp] METHOD endpoint status``."""
    c = lambda name: F.col(prefix + name)
    return F.concat(
        c("ip"), F.lit(" ["), c("timestamp"), F.lit("] "), c("method"), F.lit(" "),
        c("endpoint"), F.lit(" "), c("status").cast("string"),
    )
