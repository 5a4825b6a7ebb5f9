"""Per-packet and per-entry features: the value after each row, in arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.operators.entries import with_failed_flag
from tracewarden.plans.running import Previous, RunningDistinct, RunningSum, with_running
from tracewarden.plans.skew import hot_of_counts, split_join
from tracewarden.plans.sliding import trailing_counts
from tracewarden.session import written_table


def _one():
    return F.lit(1).cast("bigint")


def _count_ip():
    return RunningSum("packet_count_ip", ("src_ip",), _one())


def _flow_bytes():
    return RunningSum("flow_bytes", ("src_ip", "dst_ip"), F.col("size"))


def _unique_ports():
    return RunningDistinct("unique_ports", ("src_ip",), "dst_port")


def _number():
    return RunningSum("_number", (), _one())


def _last_ts():
    return Previous("_last_ts", (), F.col("ts"))


def _hits():
    return RunningSum("port_hits", ("dst_port",), _one())


def _delta():
    return F.coalesce(F.col("ts") - F.col("_last_ts"), F.lit(0.0)).alias("time_delta")


def time_delta(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    """Seconds since the previous packet of the whole input; 0 for the first; may be negative."""
    return with_running(packets, order, [_last_ts()]).select(*packets.columns, _delta())


def packet_count_ip(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    return with_running(packets, order, [_count_ip()])


def flow_bytes(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    return with_running(packets, order, [_flow_bytes()])


def unique_ports(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    return with_running(packets, order, [_unique_ports()])


def packet_rate(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Length of the queue of recent packets: it grows to its bound and stays there."""
    return with_running(packets, order, [_number()]).select(
        *packets.columns, F.least("_number", F.lit(cfg.recent_packets)).alias("packet_rate"))


def packets_per_second(packets: DataFrame) -> DataFrame:
    """A real rate, beside :func:`packet_rate`."""
    return packets.groupBy(F.floor("ts").alias("second")).agg(F.count(F.lit(1)).alias("packets"))


def packet_features(
    packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS, *more
) -> DataFrame:
    """All packet features in one pass; the rows are exchanged once."""
    specs = [_count_ip(), _flow_bytes(), _unique_ports(), _number(), _last_ts(), *more]
    return with_running(packets, order, specs).select(
        order,
        F.col("size").alias("packet_size"),
        "protocol", "src_ip", "dst_ip",
        _delta(),
        "packet_count_ip", "flow_bytes", "unique_ports", "dst_port",
        F.least("_number", F.lit(cfg.recent_packets)).alias("packet_rate"),
        F.least("_number", F.lit(cfg.volume_window)).alias("queue_length"),
        *[s.name for s in more],
    )


def alert_features(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Packet features plus the hits of the packet's port so far."""
    return packet_features(packets, order, cfg, _hits())


def port_hits(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Packets that raise the count of their port above the limit."""
    return with_running(packets, order, [_hits()]).filter(F.col("port_hits") > cfg.port_hits)


def rate_windows(packets: DataFrame, order: str, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """``src_ip, ts, in_window, first`` for times at which an address is over its rate."""
    counts = trailing_counts(packets, ["src_ip"], "ts", cfg.rate_window_s, first=F.min(order))
    return counts.filter(F.col("in_window") > cfg.rate_limit)


def rate_limited(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Packets whose address sent more than the limit in the window that ends at the packet.

    Event time, both ends included; packets with equal time count for each other.
    """
    keys = ["src_ip", "ts"]
    # Stored: the hot times are taken from it, and then it is joined.
    over = written_table(rate_windows(packets, order, cfg), "rate-windows")
    total = packets.agg(F.count(F.lit(1)).alias("n")).scalar()
    hot = hot_of_counts(over.select(*keys, F.col("at_time").alias("_n")), keys, total)
    return split_join(packets, over.select(*keys, "in_window"), keys, [order], hot=hot)


def volume_alerts(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Every packet from the one that fills the queue to the limit on; time plays no part."""
    number = with_running(packets, order, [_number()])
    return number.select(
        *packets.columns, F.least("_number", F.lit(cfg.volume_window)).alias("queue_length")
    ).filter(F.col("queue_length") >= cfg.volume_limit)


def oversized_packets(packets: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    return packets.filter(F.col("size") > cfg.max_packet_size)


def port_scan_packets(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    return unique_ports(packets, order).filter(F.col("unique_ports") >= cfg.ports_per_source)


def log_features(entries: DataFrame, order: str = "seq") -> DataFrame:
    """``failed_login, access_count_ip, unique_paths`` after each entry."""
    flagged = with_failed_flag(entries)
    return with_running(flagged, order, [
        RunningSum("access_count_ip", ("ip",), _one()),
        RunningDistinct("unique_paths", ("ip",), "endpoint"),
    ]).select(order, "ip", "failed_login", "access_count_ip", "unique_paths")


def brute_force_running(entries: DataFrame, order: str = "seq", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Every entry of an address from its fifth failed login on."""
    flagged = with_failed_flag(entries).withColumn("failed_login", F.col("failed_login").cast("bigint"))
    return with_running(flagged, order, [
        RunningSum("failed_logins", ("ip",), F.col("failed_login")),
    ]).select(order, "ip", "failed_logins").filter(F.col("failed_logins") >= cfg.failed_logins)
