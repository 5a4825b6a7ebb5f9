"""Queries over access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.catalog.registry import query
from tracewarden.catalog.views import view
from tracewarden.functions import patterns as P
from tracewarden.functions.text import LOG_LINE, second_of
from tracewarden.operators import entries as E
from tracewarden.operators import keyed, rules, running_features, stats
from tracewarden.operators.analysis import run_static_analysis
from tracewarden.session import new_folder, written_table
from tracewarden.sources import logs, sinks

_ENTRIES = ["entries"]
_LINES = ["access_log_lines"]


def entries(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "entries")


def lines(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "access_log_lines")


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any(column: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, {_lit(p)}, 'i')" for p in patterns) + ")"


def _contains_any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {_lit(w)})" for w in words) + ")"


# -- sources ----------------------------------------------------------------------------------

_FIELDS = ["ip", "timestamp", "method", "endpoint", "status", "bytes_sent",
           "referrer", "user_agent", "response_time"]
_PARSED = f"""
, matched AS (
  SELECT line_no, regexp_extract(trim(line), {_lit(LOG_LINE)}, {_FIELDS}) AS m
  FROM access_log_lines
  WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') AND regexp_matches(trim(line), {_lit(LOG_LINE)})
), parsed AS (
  SELECT line_no AS seq, m.ip AS ip, m.timestamp AS timestamp, m.method AS method, m.endpoint AS endpoint,
    CAST(m.status AS BIGINT) AS status, CAST(m.bytes_sent AS BIGINT) AS bytes_sent,
    m.referrer AS referrer, m.user_agent AS user_agent,
    coalesce(TRY_CAST(m.response_time AS BIGINT), 0) AS response_time,
    try_strptime(split_part(m.timestamp, ' ', 1), '%d/%b/%Y:%H:%M:%S') AS dt
  FROM matched
)"""


def parsed(spark, sf_dir) -> DataFrame:
    return logs.parse_lines(lines(spark, sf_dir), order="line_no").withColumnRenamed("line_no", "seq")


@query("log_scan", """
SELECT CASE WHEN line_no % 7 <> 0 AND line_no % 11 = 0 THEN concat(line, chr(65533)) ELSE line END AS line
FROM access_log_lines""", _LINES)
def _(spark, sf_dir):
    """The lines as text files, scanned: some end in a replacement character, and some of all lines in a byte that is not UTF-8."""
    folder = new_folder(spark, "log")
    real = F.when(F.col("line_no") % 11 == 0, F.unhex(F.lit("EFBFBD"))).otherwise(F.unhex(F.lit("")))
    bad = F.when(F.col("line_no") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    raw = F.concat(F.col("line").cast("binary"), real, bad)
    lines(spark, sf_dir).select(raw.cast("string").alias("line")).write.text(folder)
    return logs.log_scan(spark, folder).select("line")


@query("log_parse", _PARSED + """
SELECT seq, ip, timestamp, method, endpoint, status, bytes_sent, referrer, user_agent, response_time,
  strftime(dt, '%Y-%m-%d %H:%M:%S') AS time FROM parsed""", _LINES)
def _(spark, sf_dir):
    return parsed(spark, sf_dir).withColumn("time", second_of(F.col("dt"))).drop("dt")


@query("log_parse_stats", _PARSED + """
SELECT (SELECT count(*) FROM access_log_lines) AS total_lines,
  (SELECT count(*) FROM parsed) AS parsed_entries,
  (SELECT count(*) FROM access_log_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#'))
    - (SELECT count(*) FROM parsed) AS parse_errors""", _LINES)
def _(spark, sf_dir):
    return logs.parse_stats(lines(spark, sf_dir))


@query("log_timestamp", _PARSED + """
SELECT seq, timestamp, strftime(dt, '%Y-%m-%d %H:%M:%S') AS time, dt IS NULL AS unparsable FROM parsed""", _LINES)
def _(spark, sf_dir):
    p = parsed(spark, sf_dir)
    return p.select("seq", "timestamp", second_of(F.col("dt")).alias("time"),
                    F.col("dt").isNull().alias("unparsable"))


@query("log_file_scan", _PARSED + """
SELECT ip, timestamp, method, endpoint, status, bytes_sent, referrer, user_agent, response_time FROM parsed""", _LINES)
def _(spark, sf_dir):
    """The lines as text files, scanned and parsed."""
    folder = new_folder(spark, "log")
    lines(spark, sf_dir).select("line").write.text(folder)
    return logs.read_log(spark, folder).drop("seq", "dt")


# -- projections and filters ------------------------------------------------------------------

_SHOW = "seq, ip, timestamp, method, endpoint, status, bytes_sent, referrer, user_agent, response_time"


def _show(df: DataFrame) -> DataFrame:
    return df.select(*_SHOW.split(", "))


@query("entries_by_ip", f"SELECT {_SHOW} FROM entries WHERE ip = '10.0.22.0'", _ENTRIES)
def _(spark, sf_dir):
    return _show(E.by_ip(entries(spark, sf_dir), "10.0.22.0"))


@query("entries_by_status", f"SELECT {_SHOW} FROM entries WHERE status = 401", _ENTRIES)
def _(spark, sf_dir):
    return _show(E.by_status(entries(spark, sf_dir), 401))


@query("entries_by_method", f"SELECT {_SHOW} FROM entries WHERE upper(method) = 'POST'", _ENTRIES)
def _(spark, sf_dir):
    return _show(E.by_method(entries(spark, sf_dir), "post"))


_LINE = "concat(ip, ' [', timestamp, '] ', method, ' ', endpoint, ' ', status)"


@query("entry_render", f"""
SELECT seq, {_LINE} AS line,
  concat('{{"ip":"', ip, '","timestamp":"', timestamp, '","method":"', method, '","endpoint":"', endpoint,
    '","status":', status, ',"bytes_sent":', bytes_sent, ',"referrer":"', referrer,
    '","user_agent":"', user_agent, '","response_time":', response_time, '}}') AS json
FROM entries""", _ENTRIES)
def _(spark, sf_dir):
    return E.rendered(entries(spark, sf_dir))


@query("failed_logins", f"""
SELECT {_SHOW} FROM entries WHERE status = 401 AND contains(lower(endpoint), 'login')""", _ENTRIES)
def _(spark, sf_dir):
    return _show(E.failed_logins(entries(spark, sf_dir)))


@query("failed_login_flag", """
SELECT seq, ip, CAST(CASE WHEN status = 401 THEN 1 ELSE 0 END AS INT) AS failed_login FROM entries""", _ENTRIES)
def _(spark, sf_dir):
    return E.with_failed_flag(entries(spark, sf_dir)).select("seq", "ip", "failed_login")


@query("unique_ips", "SELECT DISTINCT ip FROM entries", _ENTRIES)
def _(spark, sf_dir):
    return E.unique(entries(spark, sf_dir), "ip")


@query("unique_endpoints", "SELECT DISTINCT endpoint FROM entries", _ENTRIES)
def _(spark, sf_dir):
    return E.unique(entries(spark, sf_dir), "endpoint")


# -- counts -----------------------------------------------------------------------------------


def _frequency(name: str, column: str):
    @query(name, f"SELECT {column}, count(*) AS count FROM entries GROUP BY {column}", _ENTRIES)
    def _(spark, sf_dir):
        return E.frequency(entries(spark, sf_dir), column)


_frequency("ip_frequency", "ip")
_frequency("status_distribution", "status")
_frequency("method_distribution", "method")


@query("top_ips", """
SELECT ip, count(*) AS count FROM entries GROUP BY ip ORDER BY count DESC, ip LIMIT 10""", _ENTRIES)
def _(spark, sf_dir):
    return E.top_n(E.frequency(entries(spark, sf_dir), "ip"), "ip", 10)


@query("requests_per_second", """
SELECT strftime(dt, '%Y-%m-%d %H:%M:%S') AS second, count(*) AS requests
FROM entries WHERE dt IS NOT NULL GROUP BY 1""", _ENTRIES)
def _(spark, sf_dir):
    return E.requests_per_second(entries(spark, sf_dir))


@query("busy_seconds", """
SELECT strftime(dt, '%Y-%m-%d %H:%M:%S') AS second, count(*) AS requests
FROM entries WHERE dt IS NOT NULL GROUP BY 1 HAVING count(*) >= 5""", _ENTRIES)
def _(spark, sf_dir):
    return rules.busy_seconds(entries(spark, sf_dir))


@query("high_activity", """
SELECT ip, count(*) AS requests FROM entries GROUP BY ip HAVING count(*) >= 20""", _ENTRIES)
def _(spark, sf_dir):
    return rules.busy_addresses(entries(spark, sf_dir))


def _summary_sql(endpoint: str, graph: str, top: int) -> str:
    return f"""
SELECT 'total_entries' AS metric, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM entries
UNION ALL SELECT 'unique_ips', '', count(DISTINCT ip) FROM entries
UNION ALL SELECT 'unique_endpoints', '', count(DISTINCT {endpoint}) FROM entries
{graph}
UNION ALL SELECT 'status', CAST(status AS VARCHAR), count(*) FROM entries GROUP BY status
UNION ALL SELECT 'method', method, count(*) FROM entries GROUP BY method
UNION ALL SELECT 'top_ip', ip, n FROM (
  SELECT ip, count(*) AS n FROM entries GROUP BY ip ORDER BY n DESC, ip LIMIT {top})"""


@query("log_summary", _summary_sql("endpoint", "", 10), _ENTRIES)
def _(spark, sf_dir):
    return stats.log_summary(entries(spark, sf_dir))


_GRAPH = """
UNION ALL SELECT 'graph_nodes', '', (SELECT count(DISTINCT ip) + count(DISTINCT endpoint) FROM entries)
UNION ALL SELECT 'graph_edges', '', (SELECT count(*) FROM entries)
UNION ALL SELECT 'graph_avg_degree', '', (SELECT count(*) FROM (SELECT DISTINCT ip, endpoint FROM entries))
  / CAST((SELECT count(DISTINCT ip) + count(DISTINCT endpoint) FROM entries) AS DOUBLE)
UNION ALL SELECT 'graph_max_degree', '', (SELECT max(d) FROM (SELECT count(DISTINCT endpoint) AS d FROM entries GROUP BY ip))
UNION ALL SELECT 'graph_min_degree', '', 0
UNION ALL SELECT 'graph_components', '', (SELECT count(DISTINCT ip) FROM entries)"""


@query("log_statistics", _summary_sql("trim(endpoint, '/')", _GRAPH, 5), _ENTRIES)
def _(spark, sf_dir):
    return stats.log_statistics(entries(spark, sf_dir))


# -- keyed maps -------------------------------------------------------------------------------

_MAP = ", counts AS (SELECT ip AS key, count(*) AS value FROM entries GROUP BY ip)"
_PROBES = ", probes AS (SELECT DISTINCT src_ip AS key FROM packets UNION SELECT DISTINCT dst_ip FROM packets)"


def _counts(spark, sf_dir):
    return keyed.increment(entries(spark, sf_dir), "ip")


def _probes(spark, sf_dir):
    p = view(spark, sf_dir, "packets")
    ends = F.explode(F.array("src_ip", "dst_ip")).alias("key")
    return p.select("src_ip", "dst_ip").distinct().select(ends).distinct()


@query("keyed_increment", """
SELECT ip AS key, CAST(sum(bytes_sent) AS BIGINT) AS value FROM entries GROUP BY ip""", _ENTRIES)
def _(spark, sf_dir):
    return keyed.increment(entries(spark, sf_dir), "ip", F.col("bytes_sent"))


@query("keyed_upsert", "SELECT ip AS key, last(status ORDER BY seq) AS value FROM entries GROUP BY ip", _ENTRIES)
def _(spark, sf_dir):
    return keyed.upsert(entries(spark, sf_dir), "ip", F.col("status"), "seq")


@query("keyed_lookup", _MAP + _PROBES + """
SELECT key, coalesce(value, -1) AS value FROM probes LEFT JOIN counts USING (key)""", ["entries", "packets"])
def _(spark, sf_dir):
    found = keyed.lookup(_probes(spark, sf_dir), _counts(spark, sf_dir))
    return found.select("key", F.coalesce("value", F.lit(-1)).alias("value"))


@query("keyed_contains", _MAP + _PROBES + """
SELECT key FROM probes WHERE key IN (SELECT key FROM counts)""", ["entries", "packets"])
def _(spark, sf_dir):
    return keyed.contains(_probes(spark, sf_dir), _counts(spark, sf_dir))


@query("keyed_remove", _MAP + _PROBES + """
SELECT key, value FROM counts WHERE key NOT IN (SELECT key FROM probes)""", ["entries", "packets"])
def _(spark, sf_dir):
    return keyed.remove(_counts(spark, sf_dir), _probes(spark, sf_dir))


@query("keyed_entries", _MAP + "\nSELECT key, value FROM counts", _ENTRIES)
def _(spark, sf_dir):
    return keyed.items(_counts(spark, sf_dir))


# -- rules ------------------------------------------------------------------------------------


def _per_entry(e, ord_, kind, severity, description, test, evidence="endpoint"):
    return f"""SELECT {ord_} AS rule_ord, '{kind}' AS type, '{severity}' AS severity, ip AS source_ip,
  {description} AS description, {evidence} AS evidence, timestamp FROM {e} WHERE {test}"""


def rule_sql(e: str = "entries") -> dict[str, str]:
    """Oracle text of each rule over the table ``e``."""
    gate = f"EXISTS (SELECT 1 FROM {e} WHERE {_contains_any('endpoint', P.SUSPICIOUS_PATH_PARTS)})"
    delta = "date_diff('second', first(dt ORDER BY seq), last(dt ORDER BY seq))"
    span = "date_diff('second', min(dt), max(dt))"
    second = "strftime(dt, '%Y-%m-%d %H:%M:%S')"
    return {
        "brute_force": f"""SELECT 1 AS rule_ord, 'BRUTE_FORCE' AS type, 'HIGH' AS severity, ip AS source_ip,
  concat(count(*), ' failed login attempts in ', {delta}, ' seconds') AS description,
  array_to_string((array_agg({_LINE} ORDER BY seq))[1:5], ' | ') AS evidence,
  first(timestamp ORDER BY seq) AS timestamp
  FROM {e} WHERE status = 401 AND contains(lower(endpoint), 'login') GROUP BY ip
  HAVING count(*) >= 5 AND {delta} <= 60""",
        "sql_injection": _per_entry(e, 2, "SQL_INJECTION", "CRITICAL",
                                    "'SQL injection pattern detected in request'", _any("endpoint", P.SQL_INJECTION)),
        "xss": _per_entry(e, 3, "XSS", "HIGH", "'XSS pattern detected in request'", _any("endpoint", P.XSS)),
        "path_traversal": _per_entry(e, 4, "PATH_TRAVERSAL", "HIGH", "'Path traversal attempt detected'",
                                     _any("endpoint", P.PATH_TRAVERSAL) + " AND " + gate),
        "port_scan": f"""SELECT 5 AS rule_ord, 'PORT_SCAN' AS type, 'MEDIUM' AS severity, ip AS source_ip,
  concat('Scanned ', count(DISTINCT endpoint), ' endpoints in ', {span}, ' seconds') AS description,
  array_to_string(list_sort(array_agg(DISTINCT endpoint))[1:5], ' | ') AS evidence,
  first(timestamp ORDER BY seq) AS timestamp
  FROM {e} GROUP BY ip
  HAVING count(DISTINCT endpoint) >= 8 AND count(dt) >= 2 AND {span} <= 5 AND NOT starts_with(ip, '/')""",
        "ddos_burst": f"""SELECT 6 AS rule_ord, 'DDOS' AS type, 'CRITICAL' AS severity,
  array_to_string(list_sort(array_agg(DISTINCT ip))[1:5], ',') AS source_ip,
  concat(count(DISTINCT ip), ' unique IPs hit ', endpoint, ' simultaneously') AS description,
  concat('Time: ', {second}, ' | Endpoint: ', endpoint) AS evidence, {second} AS timestamp
  FROM {e} WHERE dt IS NOT NULL GROUP BY endpoint, dt HAVING count(DISTINCT ip) >= 5""",
        "ddos_503": f"""SELECT 6 AS rule_ord, 'DDOS_INDICATOR' AS type, 'HIGH' AS severity, 'MULTIPLE' AS source_ip,
  concat(count(*), ' service unavailable (503) errors detected') AS description,
  array_to_string((array_agg({_LINE} ORDER BY seq))[1:3], ' | ') AS evidence,
  first(timestamp ORDER BY seq) AS timestamp
  FROM {e} WHERE status = 503 HAVING count(*) >= 3""",
        "off_hours_admin": _per_entry(
            e, 7, "OFF_HOURS_ADMIN", "MEDIUM",
            "concat('Admin access at ', lpad(CAST(hour(dt) AS VARCHAR), 2, '0'), ':00 (off-hours)')",
            "contains(lower(endpoint), 'admin') AND dt IS NOT NULL AND (hour(dt) < 6 OR hour(dt) >= 22)",
            "concat(endpoint, ' | Method: ', method)"),
        "suspicious_user_agent": f"""SELECT 8 AS rule_ord, 'SUSPICIOUS_TOOL' AS type, 'MEDIUM' AS severity,
  array_to_string(list_sort(array_agg(DISTINCT ip))[1:3], ',') AS source_ip,
  concat('Detected attack tool: ', left(user_agent, 50)) AS description,
  concat('Requests: ', count(*), ' | IPs: ', count(DISTINCT ip)) AS evidence,
  first(timestamp ORDER BY seq) AS timestamp
  FROM {e} WHERE {_any('user_agent', P.ATTACK_TOOLS)} GROUP BY user_agent""",
    }


_OUT = "rule_ord, type, severity, source_ip, description, evidence, timestamp"


def _out(threats: DataFrame) -> DataFrame:
    return threats.withColumn("evidence", F.array_join("evidence", " | ")).select(*_OUT.split(", "))


_RULES = rule_sql()
_THREATS = ", threats AS (" + "\nUNION ALL ".join(f"({sql})" for sql in _RULES.values()) + ")"
_PARSED_THREATS = ", threats AS (" + "\nUNION ALL ".join(f"({sql})" for sql in rule_sql("parsed").values()) + ")"

_RULE_FUNCTIONS = {
    "brute_force": rules.brute_force,
    "sql_injection": rules.sql_injection,
    "xss": rules.xss,
    "path_traversal": rules.path_traversal,
    "port_scan": lambda e: rules.port_scan(e).orderBy(F.desc("degree"), "source_ip"),
    "ddos_burst": rules.burst,
    "ddos_503": rules.overload,
    "off_hours_admin": rules.off_hours_admin,
    "suspicious_user_agent": rules.attack_tools,
}


def _rule(name: str):
    @query(name, _RULES[name], _ENTRIES)
    def _(spark, sf_dir):
        return _out(_RULE_FUNCTIONS[name](entries(spark, sf_dir)))


for _name in _RULES:
    _rule(_name)


@query("brute_force_sliding", """
SELECT ip, max(n) AS attempts FROM (
  SELECT ip, count(*) OVER (PARTITION BY ip ORDER BY dt RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS n
  FROM entries WHERE status = 401 AND contains(lower(endpoint), 'login') AND dt IS NOT NULL)
GROUP BY ip HAVING max(n) >= 5""", _ENTRIES)
def _(spark, sf_dir):
    return rules.brute_force_sliding(entries(spark, sf_dir))


@query("scanner_entries", f"""
SELECT {_SHOW} FROM entries WHERE ip IN (
  SELECT ip FROM entries GROUP BY ip HAVING count(DISTINCT endpoint) >= 8) AND NOT starts_with(ip, '/')""", _ENTRIES)
def _(spark, sf_dir):
    return _show(rules.scanner_entries(entries(spark, sf_dir)))


@query("matched_pattern", f"""
SELECT ip AS source_ip, endpoint, CASE
  {' '.join(f"WHEN regexp_matches(endpoint, {_lit(p)}, 'i') THEN {i}" for i, p in enumerate(P.SQL_INJECTION))}
  END AS pattern FROM entries WHERE {_any('endpoint', P.SQL_INJECTION)}""", _ENTRIES)
def _(spark, sf_dir):
    t = rules.matched_pattern(rules.sql_injection(entries(spark, sf_dir)), P.SQL_INJECTION)
    return t.select("source_ip", F.col("evidence")[0].alias("endpoint"), "pattern")


@query("detect_all", _THREATS + f"\nSELECT {_OUT} FROM threats", _ENTRIES)
def _(spark, sf_dir):
    """The rules on a stored table, as they ask for."""
    return _out(rules.detect_all(written_table(entries(spark, sf_dir), "entries")))


@query("static_analysis", _PARSED + _PARSED_THREATS + f"\nSELECT {_OUT} FROM threats", _LINES)
def _(spark, sf_dir):
    """From raw lines to threats: parse once, then run the rules on the written table."""
    return _out(rules.detect_all(written_table(parsed(spark, sf_dir), "entries")))


@query("threats_by_severity", _THREATS + f"\nSELECT {_OUT} FROM threats WHERE severity = 'HIGH'", _ENTRIES)
def _(spark, sf_dir):
    return _out(rules.detect_all(entries(spark, sf_dir), severity="HIGH"))


@query("threats_by_type", _THREATS + f"\nSELECT {_OUT} FROM threats WHERE type = 'DDOS'", _ENTRIES)
def _(spark, sf_dir):
    return _out(rules.detect_all(entries(spark, sf_dir), kind="DDOS"))


_SUMMARY = """
SELECT 'total_threats' AS metric, count(*) AS value FROM threats
UNION ALL SELECT 'unique_attackers', count(DISTINCT source_ip) FROM threats
UNION ALL SELECT lower(s) || '_count', (SELECT count(*) FROM threats WHERE severity = s)
  FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) v(s)
UNION ALL SELECT 'type_' || type, count(*) FROM threats GROUP BY type"""


@query("log_file_analysis", _PARSED + _PARSED_THREATS + f"""
, summary AS ({_SUMMARY})
, statistics AS ({_summary_sql("trim(endpoint, '/')", _GRAPH, 5).replace("FROM entries", "FROM parsed")})
SELECT metric, key, value FROM statistics
UNION ALL SELECT metric, '', value FROM summary
UNION ALL SELECT 'total_lines', '', count(*) FROM access_log_lines
UNION ALL SELECT 'parsed_entries', '', count(*) FROM parsed
UNION ALL SELECT 'parse_errors', '', (SELECT count(*) FROM access_log_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#'))
  - (SELECT count(*) FROM parsed)""", _LINES)
def _(spark, sf_dir):
    """Statistics and summary of the whole analysis of text files."""
    folder = new_folder(spark, "log")
    ordered = lines(spark, sf_dir).repartitionByRange("line_no").sortWithinPartitions("line_no")
    ordered.select("line").write.text(folder)
    result = run_static_analysis(spark, folder)
    summary = result.summary.select("metric", F.lit("").alias("key"), F.col("value").cast("double").alias("value"))
    return result.statistics.unionByName(summary)


@query("threat_summary", _THREATS + _SUMMARY, _ENTRIES)
def _(spark, sf_dir):
    return stats.threat_summary(rules.detect_all(entries(spark, sf_dir)))


@query("unique_attackers", _THREATS + "\nSELECT DISTINCT source_ip FROM threats", _ENTRIES)
def _(spark, sf_dir):
    return stats.unique_attackers(rules.detect_all(entries(spark, sf_dir)))


@query("threat_report", _THREATS + """
SELECT 0 AS section, 0 AS rule_ord, concat_ws(chr(10), repeat('=', 60), 'STATIC ANALYSIS DETECTION REPORT', repeat('=', 60),
  concat('Total Threats Detected: ', count(*)), concat('Unique Attackers: ', count(DISTINCT source_ip)), '', 'Threats by Severity:',
  concat('  CRITICAL: ', count(*) FILTER (severity = 'CRITICAL')), concat('  HIGH: ', count(*) FILTER (severity = 'HIGH')),
  concat('  MEDIUM: ', count(*) FILTER (severity = 'MEDIUM')), concat('  LOW: ', count(*) FILTER (severity = 'LOW')),
  '', repeat('-', 60), 'DETAILED THREATS:', repeat('-', 60)) AS text FROM threats
UNION ALL SELECT 1, rule_ord, concat('[', severity, '] ', type, ' from ', source_ip, ': ', description,
  array_to_string(list_transform(string_split(evidence, ' | ')[1:3], lambda x: concat(chr(10), '    Evidence: ', left(x, 80), '...')), ''), chr(10))
FROM threats
UNION ALL SELECT 2, 0, concat_ws(chr(10), repeat('-', 60), 'STATISTICS:', repeat('-', 60)) WHERE EXISTS (FROM entries)
UNION ALL SELECT 3, 0, concat('  status ', status, ': ', count(*)) FROM entries GROUP BY status
UNION ALL SELECT 4, 0, repeat('=', 60)""", _ENTRIES)
def _(spark, sf_dir):
    """The whole report, with the numbers by status as its statistics."""
    e = entries(spark, sf_dir)
    statuses = keyed.increment(e, "status").select(F.lit("status").alias("metric"), F.col("key").cast("string").alias("key"), "value")
    return sinks.threat_report(written_table(rules.detect_all(e), "threats"), statuses).select("section", "rule_ord", "text")


@query("threat_sink", _THREATS + f"\nSELECT {_OUT} FROM threats", _ENTRIES)
def _(spark, sf_dir):
    """Threats written to files and read back."""
    folder = new_folder(spark, "threats")
    sinks.write_threats(rules.detect_all(entries(spark, sf_dir)), folder)
    return _out(spark.read.parquet(folder))


@query("threat_json", _THREATS + """
SELECT rule_ord, concat('{"type":"', type, '","severity":"', severity, '","source_ip":"', source_ip,
  '","description":"', description, '","evidence":["', replace(evidence, ' | ', '","'), '"],"timestamp":"', timestamp, '"}') AS json
FROM threats""", _ENTRIES)
def _(spark, sf_dir):
    return sinks.threat_json(rules.detect_all(entries(spark, sf_dir))).select("rule_ord", "json")


# -- running features -------------------------------------------------------------------------


@query("log_running_features", """
SELECT seq, ip, CAST(CASE WHEN status = 401 THEN 1 ELSE 0 END AS INT) AS failed_login,
  count(*) OVER (PARTITION BY ip ORDER BY seq) AS access_count_ip,
  CAST(sum(f) OVER (PARTITION BY ip ORDER BY seq) AS BIGINT) AS unique_paths
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY ip, endpoint ORDER BY seq) = 1 THEN 1 ELSE 0 END AS f
  FROM entries)""", _ENTRIES)
def _(spark, sf_dir):
    return running_features.log_features(entries(spark, sf_dir))


@query("brute_force_running", """
SELECT * FROM (SELECT seq, ip,
  CAST(sum(CASE WHEN status = 401 THEN 1 ELSE 0 END) OVER (PARTITION BY ip ORDER BY seq) AS BIGINT) AS failed_logins
  FROM entries) WHERE failed_logins >= 5""", _ENTRIES)
def _(spark, sf_dir):
    return running_features.brute_force_running(entries(spark, sf_dir))
