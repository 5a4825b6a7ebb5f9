"""Streaming forms of the packet and log operators.

``order`` names the packets' order key, ``packet_no`` or the ``seq`` of :func:`tracewarden.sources.packets.packet_stream`. State per
address is kept only for what a running value needs. Features, flow bytes and the rate limit
handle the keys of a slot together (:mod:`tracewarden.streaming.slots`). A group is handled in runs of bounded size. Windowed jobs run in append mode: a
window appears once, when the watermark has passed its end; rows later than the watermark are dropped by Spark and counted by
:mod:`tracewarden.streaming.runtime`. Features, flow bytes and the rate limit have a watermark only where ``idle_state_s`` is set,
and otherwise count every row, however late.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.operators.alerts import with_anomaly
from tracewarden.plans.sliding import BUCKETS_A_SECOND
from tracewarden.streaming.slots import RUN_ROWS, Slotted, codes, place, slot

def _field(packets: DataFrame, order: str) -> str:
    return f"`{order}` {packets.schema[order].dataType.simpleString()}"


def _with_event_time(packets: DataFrame, cfg: DetectionConfig) -> DataFrame:
    timed = packets.withColumn("event_time", F.timestamp_seconds("ts"))
    return timed.withWatermark("event_time", cfg.watermark)


def late_packets(packets: DataFrame, written: DataFrame, order: str = "packet_no") -> DataFrame:
    """The rows of a table of ``packets`` that have no row in what a stream of running values has ``written``, with their
    ``late_rows`` number: those behind the watermark, once the stream has read all of the table."""
    late = packets.join(written.select(order), order, "left_anti")
    return late.crossJoin(F.broadcast(late.agg(F.count(F.lit(1)).alias("late_rows"))))


def _seconds(interval: str) -> float:
    """Seconds of an interval like ``2 minutes``."""
    number, unit = interval.split()
    units = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(number) * units[unit.removesuffix("s")]


def _runs(frames: Iterator[pd.DataFrame], order: list[str]) -> Iterator[pd.DataFrame]:
    """The rows in sorted runs of bounded size; most groups are one run."""
    waiting, rows = [], 0
    for frame in frames:
        if len(frame):
            waiting.append(frame)
            rows += len(frame)
        if rows >= RUN_ROWS:
            yield pd.concat(waiting, ignore_index=True).sort_values(order, ignore_index=True)
            waiting, rows = [], 0
    if waiting:
        yield (pd.concat(waiting, ignore_index=True) if len(waiting) > 1 else waiting[0]).sort_values(order, ignore_index=True)


def _slots(packets: DataFrame, columns: list, keys: list[str], processor: Slotted, out: str, cfg: DetectionConfig, order: str) -> DataFrame:
    """Rows of ``columns`` through the stateful ``processor``: by slots of ``keys``, or by the keys themselves where their state ends."""
    idle = cfg.idle_state_s is not None
    timed = _with_event_time(packets, cfg) if idle else packets
    rows = timed.select(*columns, *(["event_time"] if idle else []), place(*keys).alias("place"))
    grouped = rows.groupBy(*keys) if idle else rows.withColumn("slot", slot(F.col("place"))).groupBy("slot")
    return grouped.transformWithStateInPandas(
        processor, f"{_field(packets, order)}, {out}", "Append", "EventTime" if idle else "None")


class _Features(Slotted):
    """Count, last time, and the ports seen as bits, 256 to a row."""

    tables = {
        "totals": pa.schema([("src_ip", pa.string()), ("place", pa.int64()), ("packets", pa.int64()), ("ports", pa.int64()), ("last_ts", pa.float64())]),
        "ports": pa.schema([("src_ip", pa.string()), ("place", pa.int64()), ("block", pa.int64()), ("bits", pa.binary())]),
    }

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        touched = self.parts.of(rows["place"])
        totals, seen = self.parts.read("totals", touched), self.parts.read("ports", touched)
        (key, old, owner), names = codes(rows["src_ip"], totals["src_ip"], seen["src_ip"])
        places, packets, ports = (np.zeros(len(names), dtype=np.int64) for _ in range(3))
        last = np.full(len(names), np.nan)
        places[key], places[old] = rows["place"], totals["place"]
        packets[old], ports[old], last[old] = totals["packets"], totals["ports"], totals["last_ts"]
        # A missing port is one of its own, as in a table of distinct values.
        port = rows["dst_port"].fillna(-1).astype("int64").to_numpy()
        first = np.unique(key << 32 | port + (1 << 31), return_index=True)[1]
        block, bit = port[first] >> 8, port[first] & 255
        entry, at = np.unique(np.concatenate([owner << 32 | seen["block"].to_numpy() + (1 << 31), key[first] << 32 | block + (1 << 31)]),
                              return_inverse=True)
        bits = np.zeros((len(entry), 32), dtype=np.uint8)
        bits[at[:len(seen)]] = np.frombuffer(b"".join(seen["bits"]), dtype=np.uint8).reshape(-1, 32)
        at, mask = at[len(seen):], (1 << (bit & 7)).astype(np.uint8)
        new = np.zeros(len(rows), dtype=np.int64)
        new[first] = (bits[at, bit >> 3] & mask) == 0
        np.bitwise_or.at(bits, (at, bit >> 3), mask)
        ts, number = rows["ts"].to_numpy(), rows.groupby(key).cumcount().to_numpy()
        before = rows["ts"].groupby(key).shift().to_numpy()
        before = np.where(number > 0, before, last[key])
        found = rows.drop(columns=["place", "slot", "event_time"], errors="ignore").assign(
            time_delta=ts - np.where(np.isnan(before), ts, before), packet_count_ip=packets[key] + number + 1,
            unique_ports=ports[key] + pd.Series(new).groupby(key).cumsum().to_numpy())
        packets += np.bincount(key, minlength=len(names))
        np.add.at(ports, key, new)
        last[key] = ts
        self.parts.write("totals", pd.DataFrame({"src_ip": names, "place": places, "packets": packets, "ports": ports, "last_ts": last}))
        owner = entry >> 32
        self.parts.write("ports", pd.DataFrame({
            "src_ip": names[owner], "place": places[owner], "block": (entry & ((1 << 32) - 1)) - (1 << 31), "bits": [b.tobytes() for b in bits]}))
        self.parts.add(len(names) - len(totals))
        return found


def stream_packet_features(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """Running count, distinct ports and time delta per address.

    The delta is per address: a global one would need a single task. Needs the RocksDB state store, which
    :mod:`tracewarden.streaming.runtime` sets.
    """
    columns = [order, "ts", "src_ip", "dst_ip", "dst_port", "protocol", F.col("size").alias("packet_size")]
    return _slots(packets, columns, ["src_ip"], _Features(["ts", order], cfg.idle_state_s),
                  "ts double, src_ip string, dst_ip string, dst_port int, protocol string, packet_size long, "
                  "time_delta double, packet_count_ip long, unique_ports long", cfg, order)


class _Flows(Slotted):
    """Bytes of each flow."""

    tables = {"flows": pa.schema([("src_ip", pa.string()), ("dst_ip", pa.string()), ("place", pa.int64()), ("total", pa.int64())])}

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        flows = self.parts.read("flows", self.parts.of(rows["place"]))
        (src, old_src), sources = codes(rows["src_ip"], flows["src_ip"])
        (dst, old_dst), targets = codes(rows["dst_ip"], flows["dst_ip"])
        pairs, at = np.unique(np.concatenate([src, old_src]) * len(targets) + np.concatenate([dst, old_dst]), return_inverse=True)
        key, old = at[:len(rows)], at[len(rows):]
        places, total = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        places[key], places[old], total[old] = rows["place"], flows["place"], flows["total"]
        # A packet of unknown size adds nothing and has no value.
        unknown = rows["size"].isna()
        size = rows["size"].fillna(0).astype("int64")
        summed = total[key] + size.groupby(key).cumsum()
        np.add.at(total, key, size.to_numpy())
        self.parts.write("flows", pd.DataFrame({
            "src_ip": sources[pairs // len(targets)], "dst_ip": targets[pairs % len(targets)], "place": places, "total": total}))
        self.parts.add(len(pairs) - len(flows))
        summed = summed.astype("Int64").mask(unknown) if unknown.any() else summed
        return rows[[self.order[1], "ts", "src_ip", "dst_ip"]].assign(flow_bytes=summed)


def stream_flow_bytes(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """Running bytes per flow. A stream of its own, keyed by the pair: a host that reaches many others
    is many small states, not a large one."""
    return _slots(packets, [order, "ts", "src_ip", "dst_ip", "size"], ["src_ip", "dst_ip"], _Flows(["ts", order], cfg.idle_state_s),
                  "ts double, src_ip string, dst_ip string, flow_bytes long", cfg, order)


#: Buckets whose times are kept together.
TIME_BLOCK = 64


class _RateLimit(Slotted):
    """Times of an address with their counts, in buckets of a quarter of a second: totals of all buckets that a window can still
    reach, and the times of ``TIME_BLOCK`` buckets as an entry of its own. A batch reads the times of the buckets that it adds to and of
    those that its windows begin in; whole buckets between are totals."""

    tables = {
        "totals": pa.schema([("src_ip", pa.string()), ("place", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64())]),
        "times": pa.schema([("src_ip", pa.string()), ("place", pa.int64()), ("bucket", pa.int64()), ("ts", pa.float64()), ("n", pa.int64())]),
    }

    def __init__(self, order: str, cfg: DetectionConfig):
        super().__init__(["ts", order], cfg.idle_state_s)
        self.cfg = cfg

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        window, width = self.cfg.rate_window_s, self.cfg.rate_window_s * BUCKETS_A_SECOND
        reach = width + int(_seconds(self.cfg.watermark) * BUCKETS_A_SECOND)
        ts = rows["ts"].to_numpy()
        bucket = np.floor(ts * BUCKETS_A_SECOND).astype(np.int64)
        part = self.parts.of(rows["place"])
        totals = self.parts.read("totals", part)
        old_part, old_block = self.parts.of(totals["place"]), totals["bucket"].to_numpy() // TIME_BLOCK
        stored = pd.MultiIndex.from_arrays([old_part, old_block]).unique()
        needed = pd.MultiIndex.from_arrays([np.concatenate([part, part]), np.concatenate([bucket, bucket - width]) // TIME_BLOCK]).unique()
        needed = needed[needed.isin(stored)]
        times = self.parts.read("times", *(needed.get_level_values(i).to_numpy() for i in range(2)))
        (key, old, owner), names = codes(rows["src_ip"], totals["src_ip"], times["src_ip"])
        # Buckets that are gone may have left times in an entry.
        old_at = pd.MultiIndex.from_arrays([old, totals["bucket"]])
        live = pd.MultiIndex.from_arrays([owner, times["bucket"]]).isin(old_at)
        times, owner = times[live], owner[live]
        places, newest = np.zeros(len(names), dtype=np.int64), np.full(len(names), np.iinfo(np.int64).min // 2)
        places[key], places[old] = rows["place"], totals["place"]
        np.maximum.at(newest, old, totals["bucket"].to_numpy())

        # Of a bucket whose times were not read no window has an end: its packets may as well be at its beginning.
        whole = ~pd.MultiIndex.from_arrays([old_part, old_block]).isin(needed)
        who = np.concatenate([key, owner, old[whole], key, key])
        when = np.concatenate([ts, times["ts"], totals["bucket"].to_numpy()[whole] / BUCKETS_A_SECOND, ts, ts - window])
        packets = np.concatenate([np.ones(len(rows), dtype=np.int64), times["n"], totals["n"].to_numpy()[whole], np.zeros(2 * len(rows), dtype=np.int64)])
        # A window's end comes after packets of that time, its beginning before them.
        kind = np.zeros(len(who), dtype=np.int8)
        kind[len(who) - 2 * len(rows):len(who) - len(rows)], kind[len(who) - len(rows):] = 1, -1
        order = np.lexsort((kind, when, who))
        sums = np.empty(len(who), dtype=np.int64)
        sums[order] = np.cumsum(packets[order])
        found = rows[[self.order[1], "ts", "src_ip"]].assign(
            in_window=sums[len(who) - 2 * len(rows):len(who) - len(rows)] - sums[len(who) - len(rows):],
            # Their windows reach back to buckets that may be gone.
            late=bucket < newest[key] - (reach - width))

        np.maximum.at(newest, key, bucket)
        kept = pd.DataFrame({"at": np.concatenate([key, old]), "bucket": np.concatenate([bucket, totals["bucket"]]),
                             "n": np.concatenate([np.ones(len(rows), dtype=np.int64), totals["n"]])})
        kept = kept[kept["bucket"].to_numpy() >= newest[kept["at"]] - reach].groupby(["at", "bucket"], as_index=False)["n"].sum()
        at = kept["at"].to_numpy()
        self.parts.write("totals", kept.assign(src_ip=names[at], place=places[at]))
        added = pd.MultiIndex.from_arrays([part, bucket // TIME_BLOCK]).unique()
        again = pd.DataFrame({"at": np.concatenate([key, owner]), "bucket": np.concatenate([bucket, times["bucket"]]), "ts": np.concatenate([ts, times["ts"]]),
                              "n": np.concatenate([np.ones(len(rows), dtype=np.int64), times["n"]])})
        again = again[again["bucket"].to_numpy() >= newest[again["at"]] - reach].groupby(["at", "bucket", "ts"], as_index=False)["n"].sum()
        at, block = again["at"].to_numpy(), again["bucket"].to_numpy() // TIME_BLOCK
        mine = pd.MultiIndex.from_arrays([self.parts.of(places[at]), block]).isin(added)
        self.parts.write("times", again.assign(src_ip=names[at], place=places[at])[mine], block[mine])
        left = pd.MultiIndex.from_arrays([self.parts.of(places[kept["at"]]), kept["bucket"] // TIME_BLOCK])
        for gone in stored[~stored.isin(left)]:
            self.parts.remove("times", *map(int, gone))
        self.parts.add(len(names) - len(np.unique(old)))
        return found[(found["in_window"] > self.cfg.rate_limit) | found["late"]]


def rate_windows_and_late(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """``order, ts, src_ip, in_window, late``: packets of addresses above the rate in the window that ends at the packet, and
    packets that are ``late``: more than the watermark's delay older than the newest of their address in the batches before. Late ones
    are counted with what is known of their window, so they are kept, and ``in_window`` is a lower bound for them.

    State: per address, the times of the last window and of the delay before it. With ``idle_state_s`` it ends, and Spark drops rows
    behind the watermark; :func:`tracewarden.streaming.runtime.drain` counts those.
    """
    return _slots(packets, [order, "ts", "src_ip"], ["src_ip"], _RateLimit(order, cfg),
                  "ts double, src_ip string, in_window long, late boolean", cfg, order)


def stream_rate_limit(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """Packets of addresses above the rate in the window that ends at the packet."""
    return rate_windows_and_late(packets, cfg, order).filter(F.col("in_window") > cfg.rate_limit).drop("late")


def stream_port_hits(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """Packets to a port beyond its ``port_hits`` first ones. State: a count per port."""
    limit = cfg.port_hits

    def hits(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count = state.get[0] if state.exists else 0
        for run in _runs(frames, ["ts", order]):
            run["port_hits"] = count + np.arange(1, len(run) + 1)
            count += len(run)
            yield run[run["port_hits"] > limit]
        state.update((count,))

    rows = packets.select(order, "ts", "src_ip", "dst_port")
    return rows.groupBy("dst_port").applyInPandasWithState(
        hits, f"{_field(packets, order)}, ts double, src_ip string, dst_port int, port_hits long", "count long", "append",
        GroupStateTimeout.NoTimeout)


def stream_packet_volume(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> DataFrame:
    """``ts, src_ip, queue_length``: the queue's lengths from ``volume_limit`` on, each with the address that it was reached with;
    the full queue once per address and batch.

    The queue fills up once for all addresses. Of a partition only its first ``volume_window`` rows can meet a queue that is
    not full, so only those go to the one group that counts; the others go by slots of addresses. State: one count.
    """
    full, limit = cfg.volume_window, cfg.volume_limit
    places = ["ts", order]

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = None
        for frame in frames:
            first = (frame if first is None else pd.concat([first, frame], ignore_index=True)).sort_values(places)
            later, first = first.iloc[full:].drop_duplicates("src_ip"), first.iloc[:full]
            yield later.assign(full=True)
        if first is not None:
            yield first.assign(full=False, who=-1)

    def volume(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0]:
            first = None
            for run in _runs(frames, places):
                first = (run if first is None else pd.concat([first, run], ignore_index=True).sort_values(places)).drop_duplicates("src_ip")
            if first is not None and full >= limit:
                yield first[["ts", "src_ip"]].assign(queue_length=full)
            return
        count = state.get[0] if state.exists else 0
        for run in _runs(frames, places):
            run["queue_length"] = np.minimum(count + np.arange(1, len(run) + 1), full)
            count = min(count + len(run), full)
            state.update((count,))
            run = run[run["queue_length"] >= limit].drop_duplicates(["src_ip", "queue_length"])
            yield run[["ts", "src_ip", "queue_length"]]

    rows = packets.select(order, "ts", "src_ip", slot(place("src_ip")).alias("who")).mapInPandas(
        split, f"{_field(packets, order)}, ts double, src_ip string, full boolean, who int")
    return rows.groupBy("full", "who").applyInPandasWithState(
        volume, "ts double, src_ip string, queue_length long", "count long", "append", GroupStateTimeout.NoTimeout)


def feature_alerts(features: DataFrame, cfg: DetectionConfig = DEFAULTS, model: PipelineModel | None = None) -> DataFrame:
    """Alerts of the rules whose inputs the streamed features hold; needs no state.

    The rule classifier reads no flow bytes, so a constant stands for them; a fitted ``model`` must do without them too.
    """
    features = with_anomaly(features.withColumn("flow_bytes", F.lit(0)), cfg, model)
    alert = lambda kind, severity, detail: F.struct(
        F.lit(kind).alias("type"), F.lit(severity).alias("severity"), detail.alias("detail"),
        F.col("src_ip").alias("ip"), F.timestamp_seconds("ts").alias("event_time"))
    found = F.array(
        F.when(F.col("unique_ports") >= cfg.ports_per_source, alert(
            "PORT_SCAN", "high",
            F.concat(F.lit("Unusual port access count: "), F.col("unique_ports").cast("string")))),
        F.when(F.col("packet_size") > cfg.max_packet_size, alert(
            "SUSPICIOUS_PACKET", "medium",
            F.concat(F.lit("Large packet size: "), F.col("packet_size").cast("string")))),
        F.when(F.col("_anomaly"), alert(
            "ML_ANOMALY", "high", F.lit("Machine learning model flagged anomaly"))),
    )
    return features.select(F.inline(F.filter(found, lambda a: a.isNotNull())))


def stream_alert_dedup(alerts: DataFrame, cfg: DetectionConfig = DEFAULTS, forever: bool = True) -> DataFrame:
    """One alert per signature, ``forever`` (state grows with the signatures) or only within the watermark (bounded state)."""
    signature = ["type", "severity", "detail", "ip"]
    if forever:
        return alerts.dropDuplicates(signature)
    return alerts.withWatermark("event_time", cfg.watermark).dropDuplicatesWithinWatermark(signature)


def stream_alerts(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no",
                  model: PipelineModel | None = None) -> DataFrame:
    """Packets to raised alerts. The files this writes feed :func:`stream_alert_dedup`, as a second
    query: Spark allows no other stateful step after a grouped one with event-time timeout."""
    return feature_alerts(stream_packet_features(packets, cfg, order), cfg, model)


def all_alert_streams(packets: DataFrame, cfg: DetectionConfig = DEFAULTS, order: str = "packet_no") -> list[DataFrame]:
    """Packets to raised alerts of all six rules, as streams of the same columns with a state of their own each. The files
    they write are read together by :func:`stream_alert_dedup`."""
    def alerts(rows: DataFrame, kind: str, severity: str, detail) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("type"), F.lit(severity).alias("severity"), detail.alias("detail"),
            F.col("src_ip").alias("ip"), F.timestamp_seconds("ts").alias("event_time"))

    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    return [
        stream_alerts(packets, cfg, order),
        alerts(stream_port_hits(packets, cfg, order), "PORT_SCAN", "high", text("Unusual port access: ", "dst_port")),
        alerts(stream_rate_limit(packets, cfg, order), "DOS_ATTACK", "critical", F.lit("High request rate detected")),
        alerts(stream_packet_volume(packets, cfg, order), "DOS_ATTACK", "critical", text("High packet rate: ", "queue_length")),
    ]


def _timed(entries: DataFrame, cfg: DetectionConfig) -> DataFrame:
    known = entries.filter(F.col("dt").isNotNull())
    return known.withColumn("event_time", F.col("dt").cast("timestamp")).withWatermark("event_time", cfg.watermark)


def stream_burst(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Distinct addresses per endpoint and second, where there are many.

    Addresses are first made distinct and then counted, so no state row holds a set of them.
    """
    seconds = _timed(entries, cfg).select(
        F.window("event_time", "1 second").alias("second"), "endpoint", "ip")
    return (
        seconds.dropDuplicates(["second", "endpoint", "ip"])
        .groupBy("second", "endpoint").agg(F.count(F.lit(1)).alias("ips"))
        .filter(F.col("ips") >= cfg.burst_ips)
        .select("endpoint", F.col("second.start").alias("start"), "ips")
    )


def brute_force_windows(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Failed logins per address in 60 s windows every 10 s, for batch and stream alike."""
    failed = entries.filter((F.col("status") == 401) & F.contains(F.lower("endpoint"), F.lit("login")))
    width = f"{cfg.brute_force_window_s} seconds"
    return (
        failed.groupBy(F.window("event_time", width, "10 seconds").alias("w"), "ip")
        .agg(F.count(F.lit(1)).alias("attempts"))
        .filter(F.col("attempts") >= cfg.brute_force_attempts)
        .select("ip", F.col("w.start").alias("start"), "attempts")
    )


def stream_brute_force(entries: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    return brute_force_windows(_timed(entries, cfg), cfg)


def stream_sessions(packets: DataFrame, cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Activity of an address, split where it is silent for the idle gap."""
    timed = _with_event_time(packets, cfg)
    gap = f"{int(cfg.idle_gap_s * 1000)} milliseconds"
    return (
        timed.groupBy(F.session_window("event_time", gap).alias("s"), "src_ip")
        .agg(F.count(F.lit(1)).alias("packets"), F.sum("size").alias("bytes"))
        .select("src_ip", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "packets", "bytes")
    )
