"""Feature table over network flows, after the published CIC flow-feature definitions.

A flow is the unordered address pair with the port and protocol. Its forward direction is that of
its first packet. Times are in microseconds, rates per second. Only the column names are given;
what is not in the packet record (TCP flags, header lengths, windows) is NULL unless the columns
``tcp_flags``, ``header_len`` and ``win`` are supplied.

Every aggregate combines map-side. One of them makes the values of whole flows and of their directions, which are told apart
afterwards, when a flow is three rows at most. Gaps between packets come from the chunked scan. So a flow of any size is never in
one task. The table of all columns stores the gaps once; its source is read by that scan alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.plans.running import Previous, RunningSum, with_running
from tracewarden.session import written_table

FLOW = ["host_a", "host_b", "dst_port", "protocol"]
MICROS = 1_000_000

# Bits of the TCP flags byte.
FLAG_BITS = {"FIN": 1, "SYN": 2, "RST": 4, "PSH": 8, "ACK": 16, "URG": 32, "ECE": 64, "CWE": 128}


def with_flow_key(packets: DataFrame) -> DataFrame:
    return packets.withColumns({
        "host_a": F.least("src_ip", "dst_ip"),
        "host_b": F.greatest("src_ip", "dst_ip"),
    })


def _spread(value: Column, name: str) -> dict[str, Column]:
    return {
        f"{name} Mean": F.avg(value), f"{name} Std": F.stddev_samp(value),
        f"{name} Max": F.max(value), f"{name} Min": F.min(value),
    }


def _aggregated(rows: DataFrame, order: str, whole: dict[str, Column], sides: dict[str, Column]) -> DataFrame:
    """Per flow, the struct ``w`` of ``whole`` and the structs ``f`` and ``b`` of ``sides`` in the forward and backward direction."""
    named = [c.alias(f"w {n}") for n, c in whole.items()] + [c.alias(f"s {n}") for n, c in sides.items()]
    sets = [[*FLOW, "src_ip"]] + ([FLOW] if whole else [])
    per_side = rows.groupingSets(sets, *FLOW, "src_ip").agg(
        F.grouping_id().alias("_set"), F.min(order).alias("_first"), *named)
    # Rows of another set have no place among these.
    of_side = F.when(F.col("_set") == 0, F.col("_first"))
    part = lambda letter, stats: F.struct(*[F.col(f"`{letter} {n}`").alias(n) for n in stats])
    pair = per_side.groupBy(*FLOW).agg(
        F.min_by(part("s", sides), of_side).alias("f"),
        F.max_by(part("s", sides), of_side).alias("b"),
        F.count_if(F.col("_set") == 0).alias("_sides"),
        *([F.max_by(part("w", whole), F.when(F.col("_set") > 0, 1)).alias("w")] if whole else []),
    )
    return pair.withColumn("b", F.when(F.col("_sides") > 1, F.col("b"))).drop("_sides")


def _side(side: str, name: str) -> Column:
    return F.col(side)[name]


def _join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides hold one row per flow."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in FLOW})
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in FLOW]
    return left.join(renamed, match).drop(*[f"_{k}" for k in FLOW])


def _gaps(packets: DataFrame, order: str, sides: bool = True) -> DataFrame:
    """Packets with ``flow_gap``, microseconds since the flow's previous packet, and with ``side_gap``, since the previous one of
    the same direction."""
    before = {"flow_gap": tuple(FLOW)} | ({"side_gap": (*FLOW, "src_ip")} if sides else {})
    seen = with_running(with_flow_key(packets), order, [Previous(f"_{n}", keys, F.col("ts")) for n, keys in before.items()])
    return seen.withColumns({n: (F.col("ts") - F.col(f"_{n}")) * MICROS for n in before}).drop(*[f"_{n}" for n in before])


def _volume_stats(cfg: DetectionConfig) -> tuple[dict[str, Column], dict[str, Column]]:
    size = F.col("size").cast("double")
    return {
        "duration": (F.max("ts") - F.min("ts")) * MICROS, "n": F.count(F.lit(1)), "total": F.sum("size"), **_spread(size, "all"),
        "subflows": F.count_if(F.col("flow_gap") > cfg.subflow_gap_s * MICROS) + 1,
    }, {"n": F.count(F.lit(1)), "total": F.sum("size"), **_spread(size, "len")}


def _volume_columns() -> dict[str, Column]:
    seconds = _side("w", "duration") / MICROS
    # NULL instead of a division by zero.
    rate = lambda v: F.when(seconds > 0, v / seconds)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    fn, bn = zero(_side("f", "n")), zero(_side("b", "n"))
    ft, bt = zero(_side("f", "total")), zero(_side("b", "total"))
    whole = lambda n: _side("w", n)
    return {
        "Destination Port": F.col("dst_port"),
        "Flow Duration": whole("duration"),
        "Total Fwd Packets": fn,
        "Total Backward Packets": bn,
        "Total Length of Fwd Packets": ft,
        "Total Length of Bwd Packets": bt,
        **{f"{d} Packet Length {m}": _side(s, f"len {m}")
           for d, s in (("Fwd", "f"), ("Bwd", "b")) for m in ("Max", "Min", "Mean", "Std")},
        "Flow Bytes/s": rate(whole("total")),
        "Flow Packets/s": rate(whole("n")),
        "Fwd Packets/s": rate(fn),
        "Bwd Packets/s": rate(bn),
        "Min Packet Length": whole("all Min"),
        "Max Packet Length": whole("all Max"),
        "Packet Length Mean": whole("all Mean"),
        "Packet Length Std": whole("all Std"),
        "Packet Length Variance": whole("all Std") * whole("all Std"),
        "Down/Up Ratio": bn / fn,
        "Average Packet Size": whole("total") / whole("n"),
        "Avg Fwd Segment Size": _side("f", "len Mean"),
        "Avg Bwd Segment Size": _side("b", "len Mean"),
        "Subflow Fwd Packets": fn / whole("subflows"),
        "Subflow Fwd Bytes": ft / whole("subflows"),
        "Subflow Bwd Packets": bn / whole("subflows"),
        "Subflow Bwd Bytes": bt / whole("subflows"),
    }


def _iat_stats() -> tuple[dict[str, Column], dict[str, Column]]:
    gap = F.col("side_gap")
    return _spread(F.col("flow_gap"), "Flow IAT"), {"IAT Total": F.sum(gap), **_spread(gap, "IAT")}


def _iat_columns() -> dict[str, Column]:
    return {f"Flow IAT {m}": _side("w", f"Flow IAT {m}") for m in ("Mean", "Std", "Max", "Min")} | {
        f"{d} IAT {m}": _side(s, f"IAT {m}")
        for d, s in (("Fwd", "f"), ("Bwd", "b")) for m in ("Total", "Mean", "Std", "Max", "Min")}


#: TCP header fields that packets may have.
HEADER = ("tcp_flags", "header_len", "win")


def _with_header(packets: DataFrame) -> DataFrame:
    known = {c.lower() for c in packets.columns}
    return packets.withColumns({c: (F.col(c) if c in known else F.lit(None)).cast("bigint") for c in HEADER})


def _header_stats(order: str) -> dict[str, Column]:
    flags, header = F.col("tcp_flags"), F.col("header_len")
    # A sum of NULLs is NULL, so an unknown flag is not a count of zero.
    count = lambda bit: F.sum(F.when(flags.bitwiseAND(F.lit(bit).cast("bigint")) > 0, 1).when(flags.isNotNull(), 0))
    return {
        **{flag: count(bit) for flag, bit in FLAG_BITS.items()},
        "header": F.sum("header_len"),
        "header_min": F.min("header_len"),
        "win": F.min_by("win", order),
        "data": F.sum(F.when(F.col("size") > header, 1).when(header.isNotNull(), 0)),
    }


def _header_columns() -> dict[str, Column]:
    both = lambda n: _side("f", n) + F.coalesce(_side("b", n), F.lit(0))
    out = {
        "Fwd PSH Flags": _side("f", "PSH"),
        "Fwd URG Flags": _side("f", "URG"),
        "Fwd Header Length": _side("f", "header"),
        "Bwd Header Length": _side("b", "header"),
        **{f"{flag} Flag Count": both(flag)
           for flag in ("FIN", "SYN", "RST", "PSH", "ACK", "URG", "CWE", "ECE")},
        "Fwd Header Length.1": _side("f", "header"),
        "Init_Win_bytes_forward": _side("f", "win"),
        "Init_Win_bytes_backward": _side("b", "win"),
        "act_data_pkt_fwd": _side("f", "data"),
        "min_seg_size_forward": _side("f", "header_min"),
    }
    return {n: c.cast("bigint") for n, c in out.items()}


def _table(rows: DataFrame, order: str, whole: dict, sides: dict, columns: dict[str, Column]) -> DataFrame:
    return _aggregated(rows, order, whole, sides).select(*FLOW, *[c.alias(n) for n, c in columns.items()])


def flow_volume_features(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    return _table(_gaps(packets, order, sides=False), order, *_volume_stats(cfg), _volume_columns())


def flow_iat_features(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    """Gaps between successive packets of the flow and of each direction."""
    return _table(_gaps(packets, order), order, *_iat_stats(), _iat_columns())


def flow_header_features(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    """TCP header features, from the optional columns."""
    return _table(with_flow_key(_with_header(packets)), order, {}, _header_stats(order), _header_columns())


def _active_idle(rows: DataFrame, order: str, cfg: DetectionConfig) -> DataFrame:
    starts = F.when(F.col("flow_gap") > cfg.idle_gap_s * MICROS, 1).otherwise(0).cast("bigint")
    numbered = with_running(rows.withColumn("_starts", starts), order, [RunningSum("burst", tuple(FLOW), F.col("_starts"))])
    bursts = numbered.groupBy(*FLOW, "burst").agg(
        ((F.max("ts") - F.min("ts")) * MICROS).alias("active"),
        F.max(F.when(F.col("_starts") == 1, F.col("flow_gap"))).alias("idle"),
    )
    return bursts.groupBy(*FLOW).agg(
        *[c.alias(n) for n, c in _spread(F.col("active"), "Active").items()],
        *[c.alias(n) for n, c in _spread(F.col("idle"), "Idle").items()],
    )


def flow_active_idle(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Bursts of a flow are split by gaps above the idle limit: lengths of the bursts and the gaps."""
    stored = _gaps(packets, order, sides=False).select(*FLOW, order, "ts", "flow_gap")
    return _active_idle(written_table(stored, "flow-gaps"), order, cfg)


def flow_features(packets: DataFrame, order: str = "packet_no", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """All flow columns. The packets are read to find their gaps, and stored with them."""
    gaps = _gaps(_with_header(packets), order).select(
        *FLOW, "src_ip", order, "ts", "size", *HEADER, "flow_gap", "side_gap")
    rows = written_table(gaps, "flow-gaps")
    (whole, sides), (iat, iat_sides) = _volume_stats(cfg), _iat_stats()
    all_but_bursts = _table(rows, order, whole | iat, sides | iat_sides | _header_stats(order),
                            _volume_columns() | _iat_columns() | _header_columns())
    return _join(all_but_bursts, _active_idle(rows, order, cfg))
