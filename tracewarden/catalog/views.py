"""Log, packet and edge views over the driver's ``events`` table, in SQL that both engines run.

Two tokens differ per engine: ``{DT}`` (time of the burst) and ``{TS}`` (log form of a time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENS = {
    "spark": {
        "{DT}": "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, CAST(b AS INT), 0, s)",
        "{TS}": "date_format(dt, 'dd/MMM/yyyy:HH:mm:ss')",
    },
    "duckdb": {
        "{DT}": "TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(b AS INT)) + to_seconds(s)",
        "{TS}": "strftime(dt, '%d/%b/%Y:%H:%M:%S')",
    },
}

VIEWS = {
    "base": """
SELECT event_id, event_type, value, user_id,
  CAST(floor(event_id / 128) AS BIGINT) AS b,
  CAST(floor((event_id % 128) / 32) AS BIGINT) AS s,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events""",
    "access_log": """
SELECT event_id AS line_no,
  concat('10.', CAST(floor(b / 256) AS BIGINT), '.', b % 256, '.', user_id % 12) AS ip,
  {DT} AS dt,
  CASE WHEN event_type IN ('error', 'signup') THEN 'POST' ELSE 'GET' END AS method,
  CASE WHEN event_type = 'error' THEN '/usr/login'
       WHEN event_type = 'view' THEN '/usr'
       ELSE split_part('/usr|/usr/login|/usr/register|/usr/admin|/usr/admin/developer|/api/v1/users|/api/v1/data|/|/usr/|/config.php|/.git/config|/.env|/backup.sql|/usr/../../../etc/passwd|/%2e%2e/%2e%2e/etc/passwd|/usr/login?id=1%27OR%271%27=%271|/usr?id=1;DROP%20TABLE%20users|/usr?q=<script>alert(1)</script>|/usr?redirect=javascript:alert(1)|/static/css/style.css', '|', CAST(k % 20 + 1 AS INT)) END AS endpoint,
  CASE WHEN event_type = 'error' THEN 401 WHEN event_type = 'purchase' AND value > 200 THEN 503 ELSE 200 END AS status,
  CAST(100 + k * 37 AS BIGINT) AS bytes_sent,
  CASE WHEN k % 5 = 0 THEN 'http://example.com' ELSE '-' END AS referrer,
  split_part('Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/87.0.4280.141|Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_3) Safari/537.75.14|Mozilla/5.0 (Linux; Android 10) Firefox/84.0|sqlmap/1.4|Nmap/7.80|curl/7.68.0|Mozilla/5.0 (iPhone; CPU iPhone OS 12_4_9) Safari/604.1|Mozilla/5.0 (Windows NT 10.0) Edg/89.0.759.0', '|', CAST(k % 8 + 1 AS INT)) AS user_agent,
  CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE k + 10 END AS BIGINT) AS response_time
FROM base""",
    "access_log_lines": """
SELECT line_no,
  CASE WHEN line_no % 97 = 0 THEN concat('# note ', line_no)
       WHEN line_no % 89 = 0 THEN '  '
       ELSE concat(ip, ' - - [', CASE WHEN line_no % 79 = 0 THEN '01/Foo/2024:00:00:00' ELSE {TS} END, ' +0530] "', method, ' ',
            CASE WHEN line_no % 83 = 0 THEN '/api/user?id=1 OR 1' ELSE endpoint END,
            ' HTTP/1.0" ', status, ' ', bytes_sent, ' "', referrer, '" "', user_agent, '"',
            CASE WHEN response_time = 0 THEN '' ELSE concat(' ', response_time) END) END AS line
FROM access_log""",
    "entries": """
SELECT ip, concat({TS}, ' +0530') AS timestamp, method, endpoint, CAST(status AS BIGINT) AS status,
  bytes_sent, referrer, user_agent, response_time, dt, line_no AS seq
FROM access_log""",
    "packets": """
SELECT event_id AS packet_no,
  concat('10.', CAST(floor(b / 256) AS BIGINT), '.', b % 256, '.', user_id % 4) AS src_ip,
  concat('172.16.0.', k % 4) AS dst_ip,
  CAST(1000 + k AS INT) AS dst_port,
  CASE WHEN event_type = 'click' THEN 'UDP' ELSE 'TCP' END AS protocol,
  CAST(40 + floor(value * 8) AS BIGINT) AS size,
  CAST(1704067200 + b * 3600 + s + (event_id % 32) / 32.0 AS DOUBLE) AS ts
FROM base""",
    "two_way": """
SELECT packet_no, CASE WHEN packet_no % 3 = 1 THEN dst_ip ELSE src_ip END AS src_ip,
  CASE WHEN packet_no % 3 = 1 THEN src_ip ELSE dst_ip END AS dst_ip, dst_port, protocol, size, ts
FROM packets""",
    "edges": """
SELECT concat(event_type, '-', user_id) AS src,
  concat(event_type, '-', CAST(floor(user_id / CASE WHEN k % 2 = 0 THEN 2 ELSE 3 END) AS BIGINT)) AS dst,
  count(*) AS weight, min(event_id) AS first_seq
FROM base GROUP BY 1, 2""",
}

NEEDS = {
    "base": [],
    "access_log": ["base"],
    "access_log_lines": ["base", "access_log"],
    "entries": ["base", "access_log"],
    "packets": ["base"],
    "two_way": ["base", "packets"],
    "edges": ["base"],
}


def _text(name: str, engine: str) -> str:
    text = VIEWS[name]
    for token, value in TOKENS[engine].items():
        text = text.replace(token, value)
    return text


def with_clause(names, engine: str) -> str:
    wanted: list[str] = []
    for name in names:
        wanted += [v for v in [*NEEDS[name], name] if v not in wanted]
    return ",\n".join(f"{v} AS ({_text(v, engine)})" for v in wanted)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, events: DataFrame | None = None) -> DataFrame:
    """The view as a DataFrame; pass ``events`` to put it over another source, such as a stream."""
    events = table(spark, sf_dir, "events") if events is None else events
    steps = {"events": events}
    for step in [*NEEDS[name], name]:
        source = _text(step, "spark")
        for known in steps:
            source = source.replace(f"FROM {known}", "FROM {" + known + "}")
        used = {k: v for k, v in steps.items() if "{" + k + "}" in source}
        steps[step] = spark.sql(source, **used)
        if step == "access_log_lines":
            # Lines stand for text read from files: keep filters from being pushed into their making.
            steps[step] = steps[step].select("line_no", F.explode(F.array("line")).alias("line"))
    return steps[name]
