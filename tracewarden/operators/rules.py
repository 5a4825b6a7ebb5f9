"""Access-log rules. Each returns threats:
``rule_ord, type, severity, source_ip, description, evidence, timestamp, seq``.

Evidence and joined addresses that have no order of their own are the smallest ones, sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.functions import patterns as P
from tracewarden.functions.text import contains_any, entry_line, second_of
from tracewarden.operators.entries import failed_logins, requests_per_second
from tracewarden.plans.skew import rows_of_keys
from tracewarden.plans.sliding import trailing_counts
from tracewarden.plans.topk import first_k, k_smallest
from tracewarden.session import cut_lineage, written_table


def _threat(rule_ord, kind, severity, source, description, evidence, timestamp, seq) -> list[Column]:
    as_text = lambda v: F.lit(v) if isinstance(v, str) else v
    return [
        F.lit(rule_ord).alias("rule_ord"),
        F.lit(kind).alias("type"),
        F.lit(severity).alias("severity"),
        as_text(source).alias("source_ip"),
        as_text(description).alias("description"),
        evidence.alias("evidence"),
        timestamp.alias("timestamp"),
        seq.alias("seq"),
    ]


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


# -- one threat per matching entry ------------------------------------------------------------


def _sql_injection() -> tuple[Column, list[Column]]:
    return P.matches_any(F.col("endpoint"), P.SQL_INJECTION), _threat(
        2, "SQL_INJECTION", "CRITICAL", F.col("ip"), "SQL injection pattern detected in request",
        F.array("endpoint"), F.col("timestamp"), F.col("seq"))


def _xss() -> tuple[Column, list[Column]]:
    return P.matches_any(F.col("endpoint"), P.XSS), _threat(
        3, "XSS", "HIGH", F.col("ip"), "XSS pattern detected in request",
        F.array("endpoint"), F.col("timestamp"), F.col("seq"))


def _path_traversal() -> tuple[Column, list[Column]]:
    return P.matches_any(F.col("endpoint"), P.PATH_TRAVERSAL), _threat(
        4, "PATH_TRAVERSAL", "HIGH", F.col("ip"), "Path traversal attempt detected",
        F.array("endpoint"), F.col("timestamp"), F.col("seq"))


def _off_hours_admin(cfg: DetectionConfig) -> tuple[Column, list[Column]]:
    hour = F.hour("dt")
    test = (
        F.contains(F.lower("endpoint"), F.lit("admin"))
        & F.col("dt").isNotNull()
        & ((hour < cfg.work_hours_start) | (hour >= cfg.work_hours_end))
    )
    return test, _threat(
        7, "OFF_HOURS_ADMIN", "MEDIUM", F.col("ip"),
        F.format_string("Admin access at %02d:00 (off-hours)", hour),
        F.array(F.col("endpoint"), F.concat(F.lit("Method: "), F.col("method"))),
        F.col("timestamp"), F.col("seq"))


def _any_suspicious_path(entries: DataFrame) -> Column:
    """True when any path of the whole data is suspicious; each task stops at its first hit."""
    hit = entries.filter(contains_any(F.col("endpoint"), P.SUSPICIOUS_PATH_PARTS)).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()


def sql_injection(entries: DataFrame) -> DataFrame:
    test, threat = _sql_injection()
    return entries.filter(test).select(*threat)


def xss(entries: DataFrame) -> DataFrame:
    test, threat = _xss()
    return entries.filter(test).select(*threat)


def path_traversal(entries: DataFrame) -> DataFrame:
    """Emits only if some path is suspicious by the case-sensitive substring list."""
    test, threat = _path_traversal()
    return entries.filter(test & _any_suspicious_path(entries)).select(*threat)


def off_hours_admin(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    test, threat = _off_hours_admin(cfg)
    return entries.filter(test).select(*threat)


def entry_threats(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """The four per-entry rules in one pass over the entries, without a shuffle."""
    rules = [_sql_injection(), _xss(), _path_traversal(), _off_hours_admin(cfg)]
    tests = [t for t, _ in rules]
    tests[2] = tests[2] & F.col("_gate")
    found = F.array(*[F.when(test, F.struct(*rules[i][1])) for i, test in enumerate(tests)])
    gated = entries.withColumn("_gate", _any_suspicious_path(entries))
    return gated.select(F.inline(F.filter(found, lambda t: t.isNotNull())))


def matched_pattern(threats: DataFrame, patterns) -> DataFrame:
    """Which pattern of the list matched first, for reports."""
    return threats.withColumn("pattern", P.first_match(F.col("evidence")[0], patterns))


# -- one threat per group ---------------------------------------------------------------------
#
# Two passes each. The first finds the groups, with fixed-width aggregates only, so it hashes and combines
# map-side. Texts (evidence, raw timestamps) need sorting; the second pass collects them from the rows of
# the groups that were found, which are few.


def _found(groups: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    groups = cut_lineage(groups)
    # Stored: evidence and first entries are both taken from them.
    return groups, written_table(rows_of_keys(rows, groups, keys), "found-rows")


def _first_entry(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min_by("timestamp", "seq").alias("timestamp"), F.min("seq").alias("seq"))


def brute_force(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Many failed logins from one address, whose first and last in file order are close in time."""
    failed = failed_logins(entries)
    per_ip = failed.groupBy("ip").agg(
        F.count(F.lit(1)).alias("n"),
        seconds_between(F.min_by("dt", "seq"), F.max_by("dt", "seq")).alias("delta"),
    ).filter((F.col("n") >= cfg.brute_force_attempts) & (F.col("n") >= 2)
             & (F.col("delta") <= cfg.brute_force_window_s))
    per_ip, rows = _found(per_ip, failed, ["ip"])
    shown = first_k(rows, ["ip"], "seq", entry_line(), 5, "evidence")
    return per_ip.join(shown, "ip").join(_first_entry(rows, ["ip"]), "ip").select(*_threat(
        1, "BRUTE_FORCE", "HIGH", F.col("ip"),
        F.format_string("%d failed login attempts in %d seconds", "n", "delta"),
        F.col("evidence"), F.col("timestamp"), F.col("seq")))


def brute_force_sliding(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Largest number of failed logins of an address in any trailing window; an extra query."""
    timed = failed_logins(entries).withColumn("t", F.unix_seconds(F.col("dt").cast("timestamp")))
    counts = trailing_counts(timed, ["ip"], "t", cfg.brute_force_window_s)
    return counts.groupBy("ip").agg(F.max("in_window").alias("attempts")).filter(
        F.col("attempts") >= cfg.brute_force_attempts)


def scanner_addresses(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """``ip, degree``: addresses that touched many distinct endpoints."""
    return (
        entries.groupBy("ip").agg(F.count_distinct("endpoint").alias("degree"))
        .filter((F.col("degree") >= cfg.port_scan_endpoints) & ~F.startswith("ip", F.lit("/")))
    )


def scanner_entries(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """All entries of scanner addresses."""
    return rows_of_keys(entries, cut_lineage(scanner_addresses(entries, cfg)), ["ip"])


def port_scan(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Many distinct endpoints from one address within a few seconds, over its whole history."""
    per_ip = entries.groupBy("ip").agg(
        F.count_distinct("endpoint").alias("degree"),
        F.count("dt").alias("timed"),
        seconds_between(F.min("dt"), F.max("dt")).alias("delta"),
    ).filter(
        (F.col("degree") >= cfg.port_scan_endpoints) & ~F.startswith("ip", F.lit("/"))
        & (F.col("timed") >= 2) & (F.col("delta") <= cfg.port_scan_window_s)
    )
    per_ip, rows = _found(per_ip, entries, ["ip"])
    shown = k_smallest(rows, ["ip"], "endpoint", 5, "evidence")
    return per_ip.join(shown, "ip").join(_first_entry(rows, ["ip"]), "ip").select(*_threat(
        5, "PORT_SCAN", "MEDIUM", F.col("ip"),
        F.format_string("Scanned %d endpoints in %d seconds", "degree", "delta"),
        F.col("evidence"), F.col("timestamp"), F.col("seq")), "degree")


def burst(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Many distinct addresses on one endpoint within one second."""
    timed = entries.filter(F.col("dt").isNotNull()).withColumn("second", second_of(F.col("dt")))
    keys = ["endpoint", "second"]
    hits = timed.groupBy(*keys).agg(F.count_distinct("ip").alias("n")).filter(F.col("n") >= cfg.burst_ips)
    hits, rows = _found(hits, timed, keys)
    shown = k_smallest(rows, keys, "ip", 5, "ips")
    first = rows.groupBy(*keys).agg(F.min("seq").alias("seq"))
    return hits.join(shown, keys).join(first, keys).select(*_threat(
        6, "DDOS", "CRITICAL", F.array_join("ips", ","),
        F.format_string("%d unique IPs hit %s simultaneously", "n", "endpoint"),
        F.array(F.concat(F.lit("Time: "), F.col("second")),
                F.concat(F.lit("Endpoint: "), F.col("endpoint"))),
        F.col("second"), F.col("seq")))


def overload(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """At most one threat: several 503 answers in the whole data."""
    errors = entries.filter(F.col("status") == 503)
    first = errors.orderBy("seq").limit(3).select("seq", entry_line().alias("line"))
    shown = first.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda s: s["line"]).alias("evidence"))
    total = errors.agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("timestamp", "seq").alias("timestamp"),
        F.min("seq").alias("seq"),
    ).filter(F.col("n") >= cfg.unavailable_errors)
    return total.select(*_threat(
        6, "DDOS_INDICATOR", "HIGH", "MULTIPLE",
        F.format_string("%d service unavailable (503) errors detected", "n"),
        shown.scalar(), F.col("timestamp"), F.col("seq")))


def busy_seconds(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Seconds with many requests; the threshold exists but no rule uses it. An extra query."""
    return requests_per_second(entries).filter(F.col("requests") >= cfg.burst_requests)


def busy_addresses(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Addresses with many requests; as above, an extra query."""
    return entries.groupBy("ip").agg(F.count(F.lit(1)).alias("requests")).filter(
        F.col("requests") >= cfg.high_activity_requests)


def attack_tools(entries: DataFrame) -> DataFrame:
    """One threat per distinct agent text of a known tool."""
    tools = entries.filter(P.names_any(F.col("user_agent"), P.ATTACK_TOOLS))
    per_agent = tools.groupBy("user_agent").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("ip").alias("n_ips"),
    )
    shown = k_smallest(tools, ["user_agent"], "ip", 3, "ips")
    first = _first_entry(tools, ["user_agent"])
    return per_agent.join(shown, "user_agent").join(first, "user_agent").select(*_threat(
        8, "SUSPICIOUS_TOOL", "MEDIUM", F.array_join("ips", ","),
        F.concat(F.lit("Detected attack tool: "), F.left("user_agent", F.lit(50))),
        F.array(F.format_string("Requests: %d", "n"), F.format_string("IPs: %d", "n_ips")),
        F.col("timestamp"), F.col("seq")))


# -- all rules --------------------------------------------------------------------------------


#: The rules in their order: what each can raise (type and severity), and how.
RULES = [
    ({("BRUTE_FORCE", "HIGH")}, brute_force),
    ({("SQL_INJECTION", "CRITICAL"), ("XSS", "HIGH"), ("PATH_TRAVERSAL", "HIGH"), ("OFF_HOURS_ADMIN", "MEDIUM")}, entry_threats),
    ({("PORT_SCAN", "MEDIUM")}, lambda entries, cfg: port_scan(entries, cfg).drop("degree")),
    ({("DDOS", "CRITICAL")}, burst),
    ({("DDOS_INDICATOR", "HIGH")}, overload),
    ({("SUSPICIOUS_TOOL", "MEDIUM")}, lambda entries, cfg: attack_tools(entries)),
]


def detect_all(entries: DataFrame, cfg: DetectionConfig = DEFAULTS, kind: str | None = None, severity: str | None = None) -> DataFrame:
    """Threats of all rules, or of one type or severity; order them by ``rule_ord, seq``.

    Each rule scans the entries, and finding the groups runs jobs at once: pass a stored table. Rules that can't raise what is asked
    for are not run.
    """
    fits = lambda raised: any(kind in (None, k) and severity in (None, s) for k, s in raised)
    parts = [rule(entries, cfg) for raised, rule in RULES if fits(raised)]
    # A type or severity that no rule raises: any rule's rows, of which none fits.
    result = parts[0] if parts else entry_threats(entries, cfg)
    for part in parts[1:]:
        result = result.unionByName(part)
    if kind is not None:
        result = threats_by_type(result, kind)
    return result if severity is None else threats_by_severity(result, severity)


def threats_by_severity(threats: DataFrame, severity: str) -> DataFrame:
    return threats.filter(F.col("severity") == severity)


def threats_by_type(threats: DataFrame, kind: str) -> DataFrame:
    return threats.filter(F.col("type") == kind)
