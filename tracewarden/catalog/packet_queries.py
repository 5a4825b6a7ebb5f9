"""Queries over packets: running features, alerts, classifier."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewarden.catalog.registry import query
from tracewarden.catalog.views import view
from tracewarden.operators import alerts as A
from tracewarden.operators import classify as C
from tracewarden.operators import running_features as R
from tracewarden.operators import stats
from tracewarden.schema import MODEL_COLUMNS, PACKET
from tracewarden.session import new_folder
from tracewarden.sources import packets as S

_PACKETS = ["packets"]


def packets(spark, sf_dir):
    return view(spark, sf_dir, "packets")


FEATURES = """
, feats AS (
  SELECT packet_no, size AS packet_size, protocol, src_ip, dst_ip, ts,
    coalesce(ts - lag(ts) OVER (ORDER BY packet_no), 0) AS time_delta,
    count(*) OVER (PARTITION BY src_ip ORDER BY packet_no) AS packet_count_ip,
    CAST(sum(size) OVER (PARTITION BY src_ip, dst_ip ORDER BY packet_no) AS BIGINT) AS flow_bytes,
    CAST(sum(f) OVER (PARTITION BY src_ip ORDER BY packet_no) AS BIGINT) AS unique_ports,
    dst_port, least(row_number() OVER (ORDER BY packet_no), 1000) AS packet_rate,
    least(row_number() OVER (ORDER BY packet_no), 500) AS queue_length,
    count(*) OVER (PARTITION BY dst_port ORDER BY packet_no) AS port_hits,
    count(*) OVER (PARTITION BY src_ip ORDER BY ts RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS in_window
  FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY src_ip, dst_port ORDER BY packet_no) = 1 THEN 1 ELSE 0 END AS f
    FROM packets))"""

_ATTACK = "(unique_ports > 5 OR packet_count_ip > 100 OR (packet_size < 100 AND packet_count_ip > 20))"

ALERTS = FEATURES + f"""
, raised AS (
  SELECT 1 AS rule, 'PORT_SCAN' AS type, 'high' AS severity, concat('Unusual port access: ', dst_port) AS detail, src_ip AS ip, packet_no
    FROM feats WHERE port_hits > 15
  UNION ALL SELECT 2, 'DOS_ATTACK', 'critical', 'High request rate detected', src_ip, packet_no FROM feats WHERE in_window > 30
  UNION ALL SELECT 3, 'PORT_SCAN', 'high', concat('Unusual port access count: ', unique_ports), src_ip, packet_no
    FROM feats WHERE unique_ports >= 15
  UNION ALL SELECT 4, 'DOS_ATTACK', 'critical', concat('High packet rate: ', queue_length), src_ip, packet_no
    FROM feats WHERE queue_length >= 300
  UNION ALL SELECT 5, 'SUSPICIOUS_PACKET', 'medium', concat('Large packet size: ', packet_size), src_ip, packet_no
    FROM feats WHERE packet_size > 1500
  UNION ALL SELECT 6, 'ML_ANOMALY', 'high', 'Machine learning model flagged anomaly', src_ip, packet_no FROM feats WHERE {_ATTACK})
, alerts AS (
  SELECT type, severity, detail, ip, min(packet_no * 8 + rule) // 8 AS packet_no, min(packet_no * 8 + rule) % 8 AS rule
  FROM raised GROUP BY 1, 2, 3, 4)"""


def _running(name, columns, fn):
    @query(name, FEATURES + f"\nSELECT packet_no, {columns} FROM feats", _PACKETS)
    def _(spark, sf_dir):
        return fn(packets(spark, sf_dir)).select("packet_no", *columns.split(", "))


_running("time_delta", "time_delta", R.time_delta)
_running("packet_count_ip", "src_ip, packet_count_ip", R.packet_count_ip)
_running("flow_bytes", "src_ip, dst_ip, flow_bytes", R.flow_bytes)
_running("unique_ports", "src_ip, unique_ports", R.unique_ports)
_running("packet_rate", "packet_rate", R.packet_rate)
_running("packet_features",
         "packet_size, protocol, src_ip, dst_ip, time_delta, packet_count_ip, flow_bytes, unique_ports, dst_port, packet_rate",
         R.packet_features)


@query("model_input", FEATURES + """
SELECT packet_no, CAST(packet_size AS DOUBLE) AS packet_size, CAST(packet_count_ip AS DOUBLE) AS packet_count_ip,
  CAST(flow_bytes AS DOUBLE) AS flow_bytes, CAST(unique_ports AS DOUBLE) AS unique_ports, CAST(time_delta AS DOUBLE) AS time_delta
FROM feats""", _PACKETS)
def _(spark, sf_dir):
    return C.model_input(R.packet_features(packets(spark, sf_dir)))


@query("packets_per_second", """
SELECT CAST(floor(ts) AS BIGINT) AS second, count(*) AS packets FROM packets GROUP BY 1""", _PACKETS)
def _(spark, sf_dir):
    return R.packets_per_second(packets(spark, sf_dir))


@query("port_hits", FEATURES + "\nSELECT packet_no, dst_port, port_hits FROM feats WHERE port_hits > 15", _PACKETS)
def _(spark, sf_dir):
    return R.port_hits(packets(spark, sf_dir)).select("packet_no", "dst_port", "port_hits")


@query("rate_limit", FEATURES + "\nSELECT packet_no, src_ip, in_window FROM feats WHERE in_window > 30", _PACKETS)
def _(spark, sf_dir):
    return R.rate_limited(packets(spark, sf_dir)).select("packet_no", "src_ip", "in_window")


@query("packet_volume_alert", FEATURES + "\nSELECT packet_no, queue_length FROM feats WHERE queue_length >= 300", _PACKETS)
def _(spark, sf_dir):
    return R.volume_alerts(packets(spark, sf_dir)).select("packet_no", "queue_length")


@query("oversized_packet", "SELECT packet_no, src_ip, size FROM packets WHERE size > 1500", _PACKETS)
def _(spark, sf_dir):
    return R.oversized_packets(packets(spark, sf_dir)).select("packet_no", "src_ip", "size")


@query("port_scan_packets", FEATURES + "\nSELECT packet_no, src_ip, unique_ports FROM feats WHERE unique_ports >= 15", _PACKETS)
def _(spark, sf_dir):
    return R.port_scan_packets(packets(spark, sf_dir)).select("packet_no", "src_ip", "unique_ports")


@query("flow_totals", """
SELECT src_ip, dst_ip, CAST(sum(size) AS BIGINT) AS bytes FROM packets GROUP BY 1, 2""", _PACKETS)
def _(spark, sf_dir):
    return stats.flow_totals(packets(spark, sf_dir))


@query("traffic_dashboard", """
SELECT least(count(*), 1000) AS packets_shown, count(*) AS packets, count(DISTINCT src_ip) AS unique_ips FROM packets""", _PACKETS)
def _(spark, sf_dir):
    return stats.traffic_dashboard(packets(spark, sf_dir))


@query("packet_source_tcp", "SELECT packet_no, src_ip, dst_port, protocol FROM packets WHERE protocol = 'TCP'", _PACKETS)
def _(spark, sf_dir):
    return S.tcp_only(packets(spark, sf_dir)).select("packet_no", "src_ip", "dst_port", "protocol")


@query("packet_source_all", """
SELECT packet_no, src_ip, CASE WHEN protocol = 'TCP' THEN dst_port ELSE 0 END AS dst_port,
  CASE WHEN protocol = 'TCP' THEN protocol ELSE 'Other' END AS protocol FROM packets""", _PACKETS)
def _(spark, sf_dir):
    return S.all_ip(packets(spark, sf_dir)).select("packet_no", "src_ip", "dst_port", "protocol")


_FILE = "SELECT src_ip, dst_ip, dst_port, protocol, size, ts FROM packets"


def _as_file(spark, sf_dir):
    return packets(spark, sf_dir).withColumnRenamed("ts", "timestamp").drop("packet_no")


@query("packet_csv_scan", _FILE, _PACKETS)
def _(spark, sf_dir):
    """The packets as CSV files, chosen by suffix and read back."""
    folder = new_folder(spark, "packets") + ".csv"
    _as_file(spark, sf_dir).write.option("header", True).csv(folder)
    return S.packet_scan(spark, folder).drop("seq")


@query("packet_json_scan", _FILE, _PACKETS)
def _(spark, sf_dir):
    """The packets as JSON lines, read back."""
    folder = new_folder(spark, "packets")
    _as_file(spark, sf_dir).write.json(folder)
    return S.packets_from_json(spark, folder, lines=True).drop("seq")


@query("packet_scan_lines", _FILE, _PACKETS)
def _(spark, sf_dir):
    """The packets as JSON lines in a path that ends in ``.json``; the reader finds the form."""
    folder = new_folder(spark, "packets") + ".json"
    _as_file(spark, sf_dir).write.json(folder)
    return S.packet_scan(spark, folder).drop("seq")


@query("packet_json_array_scan", _FILE, _PACKETS)
def _(spark, sf_dir):
    """The packets as JSON arrays, each of them a line without an end."""
    folder = new_folder(spark, "packets") + ".json"
    rows = packets(spark, sf_dir).withColumn("file", F.col("packet_no") % 3)
    # A file is written by one task, in order, and its elements are parted by what stands before each.
    order = W.partitionBy("file").orderBy("packet_no")
    text = F.concat(
        F.when(F.lag("packet_no").over(order).isNull(), "[").otherwise(","),
        F.to_json(F.struct(*[F.col("ts" if f.name == "timestamp" else f.name).alias(f.name) for f in PACKET])),
        F.when(F.lead("packet_no").over(order).isNull(), "]").otherwise(""))
    rows.select("file", text.alias("value")).write.partitionBy("file").option("lineSep", " ").text(folder)
    return S.packet_scan(spark, folder).drop("seq")


# -- alerts -----------------------------------------------------------------------------------


def alerts(spark, sf_dir):
    return A.packet_alerts(packets(spark, sf_dir))


def _flat(df, *more):
    return df.select("type", "severity", "detail", "ip", F.col("seq.at").alias("packet_no"),
                     F.col("seq.rule").cast("bigint").alias("rule"), *more)


@query("packet_alerts", ALERTS + "\nSELECT type, severity, detail, ip, packet_no, rule FROM alerts", _PACKETS)
def _(spark, sf_dir):
    return _flat(alerts(spark, sf_dir))


@query("alert_dedup", """
SELECT 'OVERSIZED' AS type, 'medium' AS severity, concat('size ', size) AS detail, src_ip AS ip,
  min(packet_no) AS packet_no, CAST(1 AS BIGINT) AS rule
FROM packets WHERE size > 1500 GROUP BY size, src_ip""", _PACKETS)
def _(spark, sf_dir):
    raised = R.oversized_packets(packets(spark, sf_dir)).select(
        F.lit("OVERSIZED").alias("type"), F.lit("medium").alias("severity"),
        F.concat(F.lit("size "), F.col("size").cast("string")).alias("detail"),
        F.col("src_ip").alias("ip"),
        A.alert_seq(F.col("packet_no"), 1).alias("seq"))
    return _flat(A.dedup(raised))


@query("alerts_by_priority", ALERTS + """
SELECT type, severity, detail, ip, packet_no, rule,
  CAST(CASE severity WHEN 'critical' THEN 3 WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END AS INT) AS priority
FROM alerts""", _PACKETS)
def _(spark, sf_dir):
    return _flat(A.by_priority(alerts(spark, sf_dir)), "priority")


@query("alert_history", ALERTS + """
SELECT type, severity, detail, ip, packet_no, rule FROM alerts
ORDER BY packet_no DESC, rule DESC LIMIT 100""", _PACKETS)
def _(spark, sf_dir):
    return _flat(A.history(alerts(spark, sf_dir), 100))


@query("alert_origin", ALERTS + """
, addresses AS (SELECT DISTINCT ip FROM alerts)
SELECT src_ip AS ip, 'packets' AS item, '' AS key, count(*) AS value FROM packets
  WHERE src_ip IN (SELECT ip FROM addresses) GROUP BY src_ip
UNION ALL SELECT src_ip, 'port', CAST(dst_port AS VARCHAR), count(*) FROM packets
  WHERE src_ip IN (SELECT ip FROM addresses) GROUP BY src_ip, dst_port
UNION ALL SELECT src_ip, 'flow', dst_ip, CAST(sum(size) AS BIGINT) FROM packets
  WHERE src_ip IN (SELECT ip FROM addresses) GROUP BY src_ip, dst_ip""", _PACKETS)
def _(spark, sf_dir):
    return A.alert_origin(alerts(spark, sf_dir), packets(spark, sf_dir))


# -- classifier -------------------------------------------------------------------------------


def features(spark, sf_dir):
    return R.packet_features(packets(spark, sf_dir))


@query("rule_classifier", FEATURES + f"""
SELECT packet_no, CAST(CASE WHEN {_ATTACK} THEN 1 ELSE 0 END AS INT) AS prediction FROM feats""", _PACKETS)
def _(spark, sf_dir):
    return C.classify(features(spark, sf_dir)).select("packet_no", "prediction")


@query("classifier_proba", FEATURES + f"""
SELECT packet_no, CAST(CASE WHEN {_ATTACK} THEN 0.1 ELSE 0.9 END AS DOUBLE) AS p_normal,
  CAST(CASE WHEN {_ATTACK} THEN 0.9 ELSE 0.1 END AS DOUBLE) AS p_attack FROM feats""", _PACKETS)
def _(spark, sf_dir):
    return C.classify_proba(features(spark, sf_dir)).select("packet_no", "p_normal", "p_attack")


@query("ml_anomaly", FEATURES + f"\nSELECT packet_no, src_ip, unique_ports FROM feats WHERE {_ATTACK}", _PACKETS)
def _(spark, sf_dir):
    return C.anomalies(features(spark, sf_dir)).select("packet_no", "src_ip", "unique_ports")


@query("classifier_fit", FEATURES + """
, normal AS (SELECT * FROM feats WHERE protocol = 'TCP')
SELECT round(quantile_cont(CAST(packet_size AS DOUBLE), 0.95), 6) AS connection_rate,
  round(quantile_cont(CAST(packet_count_ip AS DOUBLE), 0.95), 6) AS unique_ports,
  round(quantile_cont(CAST(flow_bytes AS DOUBLE), 0.05), 6) AS avg_size FROM normal""", _PACKETS)
def _(spark, sf_dir):
    labelled = features(spark, sf_dir).withColumn("label", (F.col("protocol") != "TCP").cast("int"))
    fit = C.fit_thresholds(labelled)
    return fit.select(*[F.round(c, 6).alias(c) for c in fit.columns])


def _fitted(spark, sf_dir):
    """A tree that learned the rule from labelled features, saved and loaded."""
    labelled = features(spark, sf_dir).withColumn("label", C.is_attack(list(MODEL_COLUMNS)).cast("double"))
    folder = new_folder(spark, "model")
    C.fit_tree(labelled).save(folder)
    return C.load_model(spark, folder)


_SCORES = FEATURES + f"""
SELECT packet_no, CAST(CASE WHEN {_ATTACK} THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM feats"""


@query("model_score", _SCORES, _PACKETS)
def _(spark, sf_dir):
    """The fixture's rule is one that a tree can learn without a mistake."""
    return C.model_score(features(spark, sf_dir), _fitted(spark, sf_dir)).select("packet_no", "prediction")


@query("model_score_sql", _SCORES, _PACKETS)
def _(spark, sf_dir):
    """The same tree as a SQL expression, without vectors."""
    rule = C.tree_sql(_fitted(spark, sf_dir))
    return features(spark, sf_dir).select("packet_no", F.expr(rule).alias("prediction"))


@query("model_alerts", ALERTS + "\nSELECT type, severity, detail, ip, packet_no, rule FROM alerts", _PACKETS)
def _(spark, sf_dir):
    """All packet rules, with the fitted model in place of the rule classifier."""
    return _flat(A.packet_alerts(packets(spark, sf_dir), model=_fitted(spark, sf_dir)))
