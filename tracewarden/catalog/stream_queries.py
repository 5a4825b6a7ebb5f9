"""Streaming queries over the fixture, drained to files and read back.

The rows arrive as several files, written in stretches of their order one after the other, and each micro-batch reads a stretch: one file
of a small table, up to sixteen of a large one. State crosses batches in every query. Packets are CSV or JSON files that ``packet_stream`` reads; other rows are Parquet files. Windowed queries append a
window when the watermark has passed its end, so their oracles take the windows that end two minutes before the last event or earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.catalog.packet_queries import ALERTS, FEATURES, _ATTACK
from tracewarden.catalog.registry import query
from tracewarden.catalog.views import table, view
from tracewarden.session import new_folder, written_table
from tracewarden.sources import packets as S
from tracewarden.streaming import jobs as J
from tracewarden.streaming.runtime import chained, drain, drained, gathered, reset, table_stream

_PACKETS = ["packets"]
_ENTRIES = ["entries"]
#: Least number of micro-batches, which is even; rows of a file; files of a micro-batch where there are more of them.
BATCHES, FILE_ROWS, BATCH_FILES = 4, 250_000, 16
_written: dict[tuple, tuple[str, int]] = {}


def _parts(df: DataFrame, order: str) -> tuple[list[DataFrame], int]:
    """The rows in stretches of their order, one to a micro-batch, and the number of files of each. A partition is a file: the
    stretches of a batch are written, and read, by as many tasks."""
    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    if not n:
        return [], 1
    files = -(-n // FILE_ROWS)
    batches = max(BATCHES, -(-files // BATCH_FILES))
    batches += batches % 2
    each = -(-files // batches)
    cuts = [low + (high + 1 - low) * i // (batches * each) for i in range(batches * each + 1)]
    key, parts = F.col(order), []
    for i in range(0, batches * each, each):
        part = df.filter((key >= cuts[i]) & (key < cuts[i + each]))
        inner = sum(((key >= c).cast("int") for c in cuts[i + 1:i + each]), F.lit(0))
        part = part.repartitionById(each, inner) if each > 1 else part.coalesce(1)
        parts.append(part.sortWithinPartitions(order))
    return parts, each


def _files(spark, sf_dir: str, kind: str) -> tuple[str, int]:
    """A folder of files that arrived one batch after the other, and the number of files of a batch; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        folder = new_folder(spark, f"arrived-{kind}")
        if kind == "events":
            parts, each = _parts(table(spark, sf_dir, "events"), "event_id")
            for part in parts:
                part.write.mode("append").parquet(folder)
        else:
            parts, each = _parts(view(spark, sf_dir, "packets"), "packet_no")
            for part in parts:
                _write(part, folder, kind)
        _written[key] = folder, each
    return _written[key]


def _write(part: DataFrame, folder: str, kind: str) -> None:
    rows = part.withColumnRenamed("ts", "timestamp").drop("packet_no")
    rows.write.mode("append").option("header", True).format(kind).save(folder)


def stream(spark, sf_dir: str, name: str) -> DataFrame:
    folder, each = _files(spark, sf_dir, "events")
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", each).parquet(folder)
    return view(spark, sf_dir, name, events)


def arriving(spark, sf_dir: str, kind: str = "json") -> DataFrame:
    """Packets with their ``seq``, the files of a stretch in each micro-batch."""
    folder, each = _files(spark, sf_dir, kind)
    return S.packet_stream(spark, folder, kind, files_per_trigger=each)


_STREAMED = FEATURES + f"""
, raised AS (
  SELECT 'PORT_SCAN' AS type, 'high' AS severity, concat('Unusual port access count: ', unique_ports) AS detail, src_ip AS ip
    FROM feats WHERE unique_ports >= 15
  UNION ALL SELECT 'SUSPICIOUS_PACKET', 'medium', concat('Large packet size: ', packet_size), src_ip FROM feats WHERE packet_size > 1500
  UNION ALL SELECT 'ML_ANOMALY', 'high', 'Machine learning model flagged anomaly', src_ip FROM feats WHERE {_ATTACK})
SELECT DISTINCT type, severity, detail, ip FROM raised"""
_SIGNATURE = ["type", "severity", "detail", "ip"]


_OVERSIZED = """SELECT DISTINCT 'OVERSIZED' AS type, 'medium' AS severity, concat('size ', size) AS detail, src_ip AS ip
FROM packets WHERE size > 1500"""


def _oversized(packets: DataFrame) -> DataFrame:
    return packets.filter(F.col("size") > 1500).select(
        F.lit("OVERSIZED").alias("type"), F.lit("medium").alias("severity"),
        F.concat(F.lit("size "), F.col("size").cast("string")).alias("detail"),
        F.col("src_ip").alias("ip"), F.timestamp_seconds("ts").alias("event_time"))


@query("packet_stream_source", "SELECT src_ip, dst_ip, dst_port, protocol, size, ts FROM packets WHERE protocol = 'TCP'", _PACKETS)
def _(spark, sf_dir):
    return drained(S.tcp_only(arriving(spark, sf_dir, "csv")), "source").drop("seq")


@query("stream_packet_features", FEATURES + """
SELECT src_ip, ts, dst_port, protocol, packet_size, packet_count_ip, unique_ports,
  coalesce(ts - lag(ts) OVER (PARTITION BY src_ip ORDER BY packet_no), 0) AS time_delta FROM feats""", _PACKETS)
def _(spark, sf_dir):
    features = J.stream_packet_features(arriving(spark, sf_dir), order="seq")
    return drained(features, "features").drop("seq", "dst_ip")


@query("stream_flow_bytes", FEATURES + "\nSELECT src_ip, dst_ip, ts, flow_bytes FROM feats", _PACKETS)
def _(spark, sf_dir):
    return drained(J.stream_flow_bytes(arriving(spark, sf_dir), order="seq"), "flows").drop("seq")


@query("stream_rate_limit", FEATURES + "\nSELECT src_ip, ts, in_window FROM feats WHERE in_window > 30", _PACKETS)
def _(spark, sf_dir):
    return drained(J.stream_rate_limit(arriving(spark, sf_dir), order="seq"), "rate").drop("seq")


@query("stream_port_hits", FEATURES + "\nSELECT src_ip, ts, dst_port, port_hits FROM feats WHERE port_hits > 15", _PACKETS)
def _(spark, sf_dir):
    return drained(J.stream_port_hits(arriving(spark, sf_dir), order="seq"), "hits").drop("seq")


@query("stream_packet_volume", FEATURES + "\nSELECT DISTINCT src_ip, queue_length FROM feats WHERE queue_length >= 300", _PACKETS)
def _(spark, sf_dir):
    found = drained(J.stream_packet_volume(arriving(spark, sf_dir, "csv"), order="seq"), "volume")
    return found.select("src_ip", "queue_length").distinct()


@query("stream_pipeline", _STREAMED, _PACKETS)
def _(spark, sf_dir):
    """Packets to raised alerts to deduplicated alerts."""
    raised = J.stream_alerts(arriving(spark, sf_dir), order="seq")
    return drained(chained(raised, J.stream_alert_dedup, "raised"), "alerts").select(*_SIGNATURE)


@query("stream_all_rules", ALERTS + "\nSELECT type, severity, detail, ip FROM alerts", _PACKETS)
def _(spark, sf_dir):
    """As ``stream_pipeline``, whose SQL has three rules, with all six."""
    raised = J.all_alert_streams(arriving(spark, sf_dir), order="seq")
    return drained(gathered(raised, J.stream_alert_dedup, "raised-all"), "all-alerts").select(*_SIGNATURE)


@query("stream_alert_dedup", _OVERSIZED, _PACKETS)
def _(spark, sf_dir):
    raised = _oversized(arriving(spark, sf_dir))
    return drained(J.stream_alert_dedup(raised, forever=True), "dedup").select(*_SIGNATURE)


@query("stream_new_alerts", """
SELECT 'OVERSIZED' AS type, 'medium' AS severity, concat('size ', size) AS detail, src_ip AS ip,
  CASE WHEN min(packet_no) < any_value(middle) THEN 1 ELSE 2 END AS fetch
FROM packets, (SELECT min(packet_no) + (max(packet_no) + 1 - min(packet_no)) // 2 AS middle FROM packets)
WHERE size > 1500 GROUP BY size, src_ip""", _PACKETS)
def _(spark, sf_dir):
    """Alerts are written while packets arrive, and a reader fetches what is new: after half of the files, and at the end."""
    arrived, alerts, state, seen, reader = (
        new_folder(spark, n) for n in ("arriving", "alerts", "alerts-state", "fetched", "reader-state"))
    parts, each = _parts(view(spark, sf_dir, "packets"), "packet_no")
    for fetch, half in ((1, parts[:len(parts) // 2]), (2, parts[len(parts) // 2:])):
        for part in half:
            _write(part, arrived, "json")
        raised = J.stream_alert_dedup(_oversized(S.packet_stream(spark, arrived, files_per_trigger=each)))
        drain(raised, alerts, state)
        new = table_stream(spark, alerts, raised.schema).select(*_SIGNATURE, F.lit(fetch).alias("fetch"))
        drain(new, seen, reader)
    return spark.read.schema(new.schema).parquet(seen)


@query("stream_reset", f"SELECT *, unnest([1, 2]) AS run FROM ({_OVERSIZED})", _PACKETS)
def _(spark, sf_dir):
    """A run, which a second one continues without an alert; then a reset of output and state: every alert is raised again."""
    out, state = new_folder(spark, "reset"), new_folder(spark, "reset-state")
    alerts = J.stream_alert_dedup(_oversized(arriving(spark, sf_dir)))
    found = []
    for run in (1, 2):
        drain(alerts, out, state)
        drain(alerts, out, state)
        found.append(written_table(spark.read.schema(alerts.schema).parquet(out).select(
            *_SIGNATURE, F.lit(run).alias("run")), "reset-run"))
        reset(spark, out, state)
    return found[0].unionByName(found[1])


@query("stream_ddos_burst", """
SELECT endpoint, strftime(dt, '%Y-%m-%d %H:%M:%S') AS start, count(DISTINCT ip) AS ips FROM entries
WHERE dt + INTERVAL 1 SECOND <= (SELECT max(dt) - INTERVAL 2 MINUTE FROM entries)
GROUP BY endpoint, dt HAVING count(DISTINCT ip) >= 5""", _ENTRIES)
def _(spark, sf_dir):
    bursts = drained(J.stream_burst(stream(spark, sf_dir, "entries")), "bursts")
    return bursts.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("stream_brute_force", """
, failed AS (SELECT ip, epoch(dt)::BIGINT AS t FROM entries WHERE status = 401 AND contains(lower(endpoint), 'login'))
, placed AS (SELECT ip, unnest(range((t // 10) * 10 - 50, (t // 10) * 10 + 1, 10)) AS w FROM failed)
SELECT ip, strftime(make_timestamp(w * 1000000), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS attempts FROM placed
WHERE w + 60 <= (SELECT epoch(max(dt))::BIGINT - 120 FROM entries)
GROUP BY ip, w HAVING count(*) >= 5""", _ENTRIES)
def _(spark, sf_dir):
    windows = drained(J.stream_brute_force(stream(spark, sf_dir, "entries")), "brute-force")
    return windows.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("stream_sessions", """
, marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY src_ip ORDER BY ts) < 5 THEN 0 ELSE 1 END AS f FROM packets)
, numbered AS (SELECT *, sum(f) OVER (PARTITION BY src_ip ORDER BY ts, packet_no) AS n FROM marked)
SELECT src_ip, CAST(min(ts) * 1000000 AS BIGINT) AS start, CAST((max(ts) + 5) * 1000000 AS BIGINT) AS "end",
  count(*) AS packets, CAST(sum(size) AS BIGINT) AS bytes FROM numbered GROUP BY src_ip, n
HAVING max(ts) + 5 <= (SELECT max(ts) - 120 FROM packets)""", _PACKETS)
def _(spark, sf_dir):
    sessions = drained(J.stream_sessions(arriving(spark, sf_dir)), "sessions")
    return sessions.withColumns({
        c: F.unix_micros(c) for c in ("start", "end")})
