"""Packet alerts: rules, deduplication, ranking, history, origin."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.functions.text import severity_rank
from tracewarden.operators.classify import is_attack, model_score
from tracewarden.operators.running_features import alert_features, rate_windows
from tracewarden.plans.skew import rows_of_keys
from tracewarden.schema import MODEL_COLUMNS
from tracewarden.session import written_table

SIGNATURE = ["type", "severity", "detail", "ip"]


def alert_seq(at, rule: int):
    """What orders alerts: the order key of the packet, then the number of the rule."""
    return F.struct(at.alias("at"), F.lit(rule).alias("rule"))


def _alert(rule: int, kind: str, severity: str, detail, at):
    return F.struct(
        F.lit(kind).alias("type"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
        F.col("src_ip").alias("ip"),
        alert_seq(at, rule).alias("seq"),
    )


def with_anomaly(features: DataFrame, cfg: DetectionConfig = DEFAULTS, model: PipelineModel | None = None) -> DataFrame:
    """Features with ``_anomaly``: what the fitted model says, or the rule classifier where there is none."""
    if model is None:
        return features.withColumn("_anomaly", is_attack(list(MODEL_COLUMNS), cfg) == 1)
    return model_score(features, model).withColumn("_anomaly", F.col("prediction") == 1).drop("prediction")


def feature_alerts(features: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS,
                   model: PipelineModel | None = None) -> DataFrame:
    """Alerts of the rules that look at one packet's features, in rule order."""
    at, features = F.col(order), with_anomaly(features, cfg, model)
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    found = F.array(
        F.when(F.col("port_hits") > cfg.port_hits,
               _alert(1, "PORT_SCAN", "high", text("Unusual port access: ", "dst_port"), at)),
        F.when(F.col("unique_ports") >= cfg.ports_per_source,
               _alert(3, "PORT_SCAN", "high", text("Unusual port access count: ", "unique_ports"), at)),
        F.when(F.col("queue_length") >= cfg.volume_limit,
               _alert(4, "DOS_ATTACK", "critical", text("High packet rate: ", "queue_length"), at)),
        F.when(F.col("packet_size") > cfg.max_packet_size,
               _alert(5, "SUSPICIOUS_PACKET", "medium", text("Large packet size: ", "packet_size"), at)),
        F.when(F.col("_anomaly"),
               _alert(6, "ML_ANOMALY", "high", F.lit("Machine learning model flagged anomaly"), at)),
    )
    return features.select(F.inline(F.filter(found, lambda a: a.isNotNull())))


def rate_alerts(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """One alert per time at which an address is over its rate, at the first packet of that time."""
    return rate_windows(packets, order, cfg).select(
        _alert(2, "DOS_ATTACK", "critical", F.lit("High request rate detected"), F.col("first")).alias("a")
    ).select("a.*")


def dedup(alerts: DataFrame) -> DataFrame:
    """The first alert of each signature. A minimum per group: a hot signature combines map-side."""
    # Plain minima are hash aggregates; the order keys are compared whole when few rows are left.
    firsts = alerts.groupBy(*SIGNATURE, F.col("seq.rule").alias("rule")).agg(F.min("seq.at").alias("at"))
    return firsts.groupBy(*SIGNATURE).agg(F.min(F.struct("at", "rule")).alias("seq"))


def packet_alerts(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS,
                  model: PipelineModel | None = None) -> DataFrame:
    """All packet rules, deduplicated."""
    by_packet = feature_alerts(alert_features(packets, order, cfg), order, cfg, model)
    return dedup(by_packet.unionByName(rate_alerts(packets, order, cfg)))


def by_priority(alerts: DataFrame) -> DataFrame:
    """Most severe first; equal severities in order of arrival."""
    return alerts.withColumn("priority", severity_rank(F.col("severity"))).orderBy(
        F.desc("priority"), "seq")


def history(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` distinct alerts."""
    return alerts.orderBy(F.desc("seq")).limit(n)


def alert_origin(alerts: DataFrame, packets: DataFrame) -> DataFrame:
    """For each address that has an alert, what is known of it, as rows ``ip, item, key, value``.

    Items: ``packets`` (count), ``port`` (each observed port, with its packets) and ``flow``
    (bytes to each destination). Rows instead of lists, since one scanner can reach any number of hosts.
    """
    addresses = written_table(alerts.select("ip").filter(F.col("ip").isNotNull()).distinct(), "alert-addresses")
    # Ports and flows in one pass; the semi join then works on totals, not on packets.
    totals = packets.withColumnRenamed("src_ip", "ip").groupingSets([["ip", "dst_port"], ["ip", "dst_ip"]], "ip", "dst_port", "dst_ip").agg(
        (F.grouping_id() == 1).alias("of_port"), F.count(F.lit(1)).alias("packets"), F.sum("size").alias("bytes"))
    found = rows_of_keys(totals, addresses, ["ip"]).select(
        "ip", F.when(F.col("of_port"), "port").otherwise("flow").alias("item"),
        F.when(F.col("of_port"), F.col("dst_port").cast("string")).otherwise(F.col("dst_ip")).alias("key"),
        F.when(F.col("of_port"), F.col("packets")).otherwise(F.col("bytes")).alias("value"))
    found = written_table(found, "alert-origins")
    return found.unionByName(found.filter(F.col("item") == "port").groupBy("ip").agg(F.sum("value").alias("value")).select(
        "ip", F.lit("packets").alias("item"), F.lit("").alias("key"), "value"))
