"""Streams over several micro-batches, and over a restart, equal their batch twins."""

import csv
import json
import os
from collections import Counter
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewarden.catalog import stream_queries
from tracewarden import session
from tracewarden.config import DEFAULTS
from tracewarden.operators import alerts as A
from tracewarden.operators import running_features as R
from tracewarden.sources.packets import _csv_stream, _json_stream, packet_stream
from tracewarden.streaming import jobs as J
from tracewarden.streaming import slots
from tracewarden.streaming.runtime import _rocksdb, drain, drained, gathered, reset, table_stream

SCHEMA = "packet_no long, src_ip string, dst_ip string, dst_port int, protocol string, size long, ts double"


def packet_rows():
    return [(i, f"h{i % 3}", f"d{i % 2}", 100 + (i * 7) % 23, "TCP", 40 + i, 1000.0 + i / 4) for i in range(300)]


def write(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_features_continue_after_restart(spark, tmp_path):
    rows, folder = packet_rows(), str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for n in range(3):
        write(spark, folder, rows[n * 100:(n + 1) * 100], f"b{n}")
        drain(J.stream_packet_features(source(spark, folder)), out, state)
    got = spark.read.parquet(out).orderBy("packet_no").collect()
    batch = R.packet_features(spark.createDataFrame(rows, SCHEMA)).orderBy("packet_no").collect()
    assert [(r.packet_count_ip, r.unique_ports) for r in got] == [(r.packet_count_ip, r.unique_ports) for r in batch]
    assert all(r.time_delta == 0.75 for r in got[3:])


def test_rate_limit_over_batches(spark, tmp_path):
    rows, folder = packet_rows(), str(tmp_path / "in")
    for n in range(3):
        write(spark, folder, rows[n * 100:(n + 1) * 100], f"b{n}")
    drain(J.stream_rate_limit(source(spark, folder)), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {(r.packet_no, r.in_window) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = R.rate_limited(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got == {(r.packet_no, r.in_window) for r in batch} and got


def test_late_rows_and_repeated_alerts_over_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    row = lambda n, ts: (n, "a", "b", 22, "TCP", 40, float(ts))
    # 30 packets and a later one; in the next batch one that is late, but not too late for the watermark.
    first = [row(i, 1000) for i in range(30)] + [row(30, 1090)]
    write(spark, folder, first, "b0")
    write(spark, folder, [row(31, 1010)], "b1")
    drain(J.stream_rate_limit(source(spark, folder)), str(tmp_path / "out"), str(tmp_path / "state"))
    assert [(r.packet_no, r.in_window) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(31, 31)]
    for n in range(3):
        write(spark, str(tmp_path / "far"), [row(n, 1000 * (n + 1))], f"b{n}")
    alerts = J.stream_alert_dedup(source(spark, str(tmp_path / "far")).select(
        F.lit("T").alias("type"), F.lit("low").alias("severity"), F.lit("d").alias("detail"), F.col("src_ip").alias("ip"),
        F.timestamp_seconds("ts").alias("event_time")))
    drain(alerts, str(tmp_path / "alerts"), str(tmp_path / "alerts-state"))
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 1


def test_new_alerts_and_reset(spark, tmp_path):
    rows, folder = packet_rows(), str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    alert = lambda df: J.stream_alert_dedup(df.select(
        F.lit("T").alias("type"), F.lit("low").alias("severity"), F.col("dst_ip").alias("detail"),
        F.col("src_ip").alias("ip"), F.timestamp_seconds("ts").alias("event_time")))
    fetched = lambda: drain(
        table_stream(spark, out, alert(source(spark, folder)).schema), str(tmp_path / "seen"), str(tmp_path / "reader"))
    write(spark, folder, rows[:2], "b0")
    drain(alert(source(spark, folder)), out, state)
    fetched()
    assert spark.read.parquet(str(tmp_path / "seen")).count() == 2
    write(spark, folder, rows[2:], "b1")
    drain(alert(source(spark, folder)), out, state)
    fetched()
    assert spark.read.parquet(str(tmp_path / "seen")).count() == 6
    # A new checkpoint and output forget everything.
    drain(alert(source(spark, folder)), str(tmp_path / "out2"), str(tmp_path / "state2"))
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 6


def test_rows_of_any_lateness_count(spark, tmp_path):
    folder = str(tmp_path / "in")
    row = lambda n, ts: (n, "a", "b", 20 + n, "TCP", 40, float(ts))
    # The third batch is an hour older than the first two (Spark drops by the watermark of the batch before), the fourth goes on.
    for n, rows in enumerate(([row(0, 9000)], [row(1, 9001)], [row(2, 5400), row(3, 5401)], [row(4, 9002)])):
        write(spark, folder, rows, f"b{n}")
    features, flows, some = (str(tmp_path / x) for x in ("features", "flows", "some"))
    drain(J.stream_packet_features(source(spark, folder)), features, str(tmp_path / "s0"))
    drain(J.stream_flow_bytes(source(spark, folder)), flows, str(tmp_path / "s1"))
    got = spark.read.parquet(features).orderBy("packet_no").collect()
    assert [(r.packet_no, r.packet_count_ip, r.unique_ports) for r in got] == [(n, n + 1, n + 1) for n in range(5)]
    got = spark.read.parquet(flows).orderBy("packet_no").collect()
    assert [(r.packet_no, r.flow_bytes) for r in got] == [(n, 40 * (n + 1)) for n in range(5)]
    # State that ends needs the watermark; what is behind it goes to a table of its own.
    drain(J.stream_flow_bytes(source(spark, folder), replace(DEFAULTS, idle_state_s=86400.0)), some, str(tmp_path / "s2"))
    late = J.late_packets(spark.read.schema(SCHEMA).parquet(f"{folder}/*"), spark.read.parquet(some)).orderBy("packet_no").collect()
    assert [(r.packet_no, r.late_rows) for r in late] == [(2, 2), (3, 2)]


def test_all_six_rules_over_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    # The queue is at 290 after the first batch and fills up in the second, which holds more than a queue itself.
    rows = [(i, f"h{i % 5}", "d", 100 + i % 37, "TCP", 1480 + i % 25, 1000.0 + i / 4) for i in range(1200)]
    for n, (a, b) in enumerate(((0, 290), (290, 1100), (1100, 1200))):
        write(spark, folder, rows[a:b], f"b{n}")
    raised = drained(gathered(J.all_alert_streams(source(spark, folder)), J.stream_alert_dedup, "raised"), "six")
    got = sorted(tuple(r) for r in raised.select(*A.SIGNATURE).collect())
    want = sorted(tuple(r) for r in A.packet_alerts(spark.createDataFrame(rows, SCHEMA)).select(*A.SIGNATURE).collect())
    assert got == want
    kinds = {(r[0], r[2].split(":")[0]) for r in got}
    assert kinds >= {("PORT_SCAN", "Unusual port access"), ("DOS_ATTACK", "High request rate detected"), ("DOS_ATTACK", "High packet rate")}


@pytest.mark.parametrize("fmt", ["csv", "lines", "array"])
def test_packet_stream_feeds_all_operators(spark, tmp_path, fmt):
    folder, rows = tmp_path / "in", [(f"h{i % 3}", "d, \"x\"", 100 + (i * 7) % 23, "TCP", 1400 + i, 1000.0 + i / 4) for i in range(300)]
    names = ["src_ip", "dst_ip", "dst_port", "protocol", "size", "timestamp"]
    folder.mkdir()
    for n in range(3):
        part = [dict(zip(names, r)) for r in rows[n * 100:(n + 1) * 100]]
        with open(folder / f"{n}.{fmt}", "w", newline="") as f:
            if fmt == "csv":
                writer = csv.DictWriter(f, ["more", *reversed(names)], escapechar="\\", doublequote=False)
                writer.writeheader()
                writer.writerows(part)
            else:
                f.write(json.dumps(part, indent=1) if fmt == "array" else "\n".join(map(json.dumps, part)) + "\n\n")
        os.utime(folder / f"{n}.{fmt}", (1000 + n, 1000 + n))
    packets = packet_stream(spark, str(folder), "csv" if fmt == "csv" else "json", files_per_trigger=1)
    batch = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    plain = lambda df, *columns: sorted(tuple(r) for r in df.select(*columns).collect())
    stored = drained(packets, "stored").orderBy("seq").collect()
    assert [(r.src_ip, r.dst_ip, r.dst_port, r.protocol, r.size, r.ts) for r in stored] == rows
    for streamed, want, columns in (
        (J.stream_packet_features(packets, order="seq"), R.packet_features(batch).join(batch.select("packet_no", "ts"), "packet_no"),
         ("src_ip", "ts", "packet_count_ip", "unique_ports")),
        (J.stream_flow_bytes(packets, order="seq"), R.flow_bytes(batch), ("src_ip", "dst_ip", "ts", "flow_bytes")),
        (J.stream_rate_limit(packets, order="seq"), R.rate_limited(batch), ("src_ip", "ts", "in_window")),
        (J.stream_port_hits(packets, order="seq"), R.port_hits(batch), ("src_ip", "ts", "dst_port", "port_hits")),
    ):
        assert plain(drained(streamed, "streamed"), *columns) == plain(want, *columns)
    raised = drained(gathered(J.all_alert_streams(packets, order="seq"), J.stream_alert_dedup, "raised"), "alerts")
    assert plain(raised, *A.SIGNATURE) == plain(A.packet_alerts(batch), *A.SIGNATURE)


def test_streamed_files_that_cannot_be_read_raise(spark, tmp_path):
    for name, fmt, text in (("a", "csv", "src_ip,dst_ip\na,b\n"), ("b", "json", '{"src_ip": \n'), ("c", "json", '[{"src_ip": "a"}'),
                            ("d", "csv", "src_ip,dst_ip,dst_port,protocol,size,timestamp\na,b,x,TCP,1,2\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(text)
        with pytest.raises(Exception):
            drained(packet_stream(spark, str(tmp_path / name), fmt), "bad")
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "f").write_text("")
    assert drained(packet_stream(spark, str(tmp_path / "e"), "json"), "empty").count() == 0


def test_a_hot_address_is_handled_in_runs(spark, tmp_path, monkeypatch):
    n = 1_000_000
    spark.range(0, n, numPartitions=1).select(
        F.col("id").alias("packet_no"), F.lit("hot").alias("src_ip"), F.lit("d").alias("dst_ip"),
        ((F.col("id") * 40503) % 65536).cast("int").alias("dst_port"), F.lit("TCP").alias("protocol"), F.lit(40).cast("long").alias("size"),
        (F.lit(1000.0) + F.col("id") / 16384).alias("ts")).write.parquet(str(tmp_path / "in" / "b0"))
    found = drained(J.stream_packet_features(source(spark, str(tmp_path / "in"))), "hot")
    row = found.agg(F.max("packet_count_ip"), F.max("unique_ports"), F.count(F.lit(1)), F.count_if(F.col("packet_count_ip") != F.col("packet_no") + 1)).first()
    assert tuple(row) == (n, 65536, n, 0)
    late = drained(J.stream_rate_limit(source(spark, str(tmp_path / "in")), replace(DEFAULTS, rate_window_s=2)), "hot-rate")
    bad = late.filter(F.col("in_window") != F.least(F.col("packet_no") + 1, F.lit(32769)))
    assert late.count() == n - DEFAULTS.rate_limit and bad.count() == 0


def test_late_packets_are_kept_and_flagged(spark, tmp_path):
    folder = str(tmp_path / "in")
    row = lambda n, ts: (n, "a", "b", 22, "TCP", 40, float(ts))
    write(spark, folder, [row(i, 1000) for i in range(40)], "b0")
    write(spark, folder, [row(40, 2000)], "b1")
    write(spark, folder, [row(41, 1000), row(42, 1950)], "b2")
    found = drained(J.rate_windows_and_late(source(spark, folder)), "late").orderBy("packet_no").collect()
    assert [(r.packet_no, r.in_window, r.late) for r in found if r.packet_no > 39] == [(41, 1, True)]
    assert len(found) == 41 and not any(r.late for r in found[:40])
    # With state that ends, Spark drops such rows (by the watermark of the batch before), and draining counts them.
    write(spark, folder, [row(43, 1000), row(44, 2001)], "b3")
    dropped = drain(J.stream_flow_bytes(source(spark, folder), replace(DEFAULTS, idle_state_s=60.0)), str(tmp_path / "o"), str(tmp_path / "c"))
    assert sum(dropped.values()) == 1 and spark.read.parquet(str(tmp_path / "o")).count() == 44


def test_idle_state_ends(spark, tmp_path):
    folder, cfg = str(tmp_path / "in"), replace(DEFAULTS, idle_state_s=10.0)
    row = lambda n, ip, ts: (n, ip, "b", 22, "TCP", 40, float(ts))
    for n, rows in enumerate(([row(0, "a", 1000), row(1, "a", 1001)], [row(2, "b", 9000)], [row(3, "b", 9001)], [row(4, "a", 9002)])):
        write(spark, folder, rows, f"b{n}")
    found = drained(J.stream_packet_features(source(spark, folder), cfg), "idle").orderBy("packet_no").collect()
    assert [(r.packet_no, r.packet_count_ip, r.unique_ports) for r in found] == [(0, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 1, 1)]


def test_a_repeated_batch_writes_nothing_twice(spark, tmp_path):
    rows, folder = packet_rows(), str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sums = lambda: J.stream_flow_bytes(source(spark, folder))
    write(spark, folder, rows[:200], "b0")
    drain(sums(), out, state)
    before = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    # The batch was written, but the query ended before it was committed.
    commits = sorted((p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    write(spark, folder, rows[200:], "b1")
    drain(sums(), out, state)
    want = R.flow_bytes(spark.createDataFrame(rows, SCHEMA)).select("packet_no", "ts", "src_ip", "dst_ip", "flow_bytes")
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*want.columns).collect())
    assert got == sorted(tuple(r) for r in want.collect()) and set(before) < set(got)


def test_reset_forgets(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    write(spark, folder, packet_rows(), "b0")
    hits = J.stream_flow_bytes(source(spark, folder))
    for _ in range(2):
        drain(hits, out, state)
        assert spark.read.parquet(out).agg(F.max("flow_bytes"), F.count(F.lit(1))).first()[1] == 300
    reset(spark, out, state)
    assert not (tmp_path / "out").exists() and not (tmp_path / "state").exists()
    drain(hits, out, state)
    assert spark.read.parquet(out).count() == 300


def test_shared_folder(spark, monkeypatch):
    folder = session.shared_folder(spark)
    assert session.shared_folder(spark) == folder == spark.conf.get(session.CHECKPOINT_KEY)

    class Cluster:
        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default: None)

    with pytest.raises(ValueError):
        session.shared_folder(Cluster)


def test_a_csv_file_is_split_once_and_a_line_parsed_once(spark, tmp_path):
    """The rows of a file once split its whole text again, for each use of each cell of its first line."""
    (tmp_path / "a.csv").write_text("size,src_ip,dst_ip,dst_port,protocol,timestamp\r\n7,a,b,80,TCP,1.5\r\n\r\n9,c,\"d,e\",81,UDP,2\n")
    files = spark.read.text(str(tmp_path), wholetext=True).withColumn("path", F.lit("p"))
    rows = _csv_stream(files).select("pos", "packet.*")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "a", "b", 80, "TCP", 7, 1.5), (3, "c", "d,e", 81, "UDP", 9, 2.0)]
    plan = rows.filter("protocol = 'TCP'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1 and plan.count("from_csv(") == 2


def test_stretches_of_a_large_table_are_several_files_each(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 10)
    monkeypatch.setattr(stream_queries, "BATCH_FILES", 3)
    parts, each = stream_queries._parts(spark.range(5, 155).withColumnRenamed("id", "k"), "k")
    assert (len(parts), each) == (6, 3)
    rows = [(i, r.file, r.k) for i, p in enumerate(parts) for r in p.select("k", F.spark_partition_id().alias("file")).collect()]
    files = Counter((i, file) for i, file, _ in rows)
    assert [k for *_, k in rows] == list(range(5, 155)) and len(files) == 18 and max(files.values()) <= 10
    few, one = stream_queries._parts(spark.range(8).withColumnRenamed("id", "k"), "k")
    assert (len(few), one) == (4, 1)
    assert stream_queries._parts(spark.range(0).withColumnRenamed("id", "k"), "k") == ([], 1)


class _Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def iterator(self):
        return iter(self.items())


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    getValueState = staticmethod(lambda name, schema: _Value())
    getMapState = staticmethod(lambda name, key, value: _Map())


def test_parts_of_a_slot_double_with_its_keys():
    parts = slots.Parts(_Handle, {"t": pa.schema([("place", pa.int64()), ("n", pa.int64())])}).open()
    for first in range(0, 1000, 100):
        places = (np.arange(first, first + 100) << 20) + 7
        new = pd.concat([parts.read("t", parts.of(places)), pd.DataFrame({"place": places, "n": np.arange(first, first + 100)})])
        parts.write("t", new)
        parts.add(100)
    assert parts.size.get() == (1000, 4) and len(parts.maps["t"]) <= 16
    rows = parts.read("t", np.arange(16))
    assert sorted(rows["n"]) == list(range(1000)) and (rows["place"] == rows["n"] * (1 << 20) + 7).all()


def test_runs_of_a_slot_keep_the_rows_of_a_key_together():
    frames = [pd.DataFrame({"place": [i % 5, 9, 9, 9], "ts": [10 - i, i, i, i]}) for i in range(10)]
    runs = list(slots.slot_runs(iter(frames), ["ts"], 12))
    assert [len(r) for r in runs] == [18, 22]
    assert set(runs[0]["place"]) == {9} and sorted(runs[-1]["place"])[:10] == sorted([*range(5)] * 2)
    assert all(r["ts"].is_monotonic_increasing for r in runs)


def test_many_keys_are_few_calls(spark, tmp_path):
    """A call of Python for each key and batch took most of the time."""
    folder = str(tmp_path / "in")
    rows = [(i, f"h{i * 7 % 900}", f"d{i % 2}", 100 + i % 3, "TCP", 40 + i, 1000.0 + i / 512) for i in range(4000)]
    for n, (a, b) in enumerate(((0, 1500), (1500, 4000))):
        write(spark, folder, rows[a:b], f"b{n}")
    batch, packets = spark.createDataFrame(rows, SCHEMA), source(spark, folder)
    low = replace(DEFAULTS, rate_limit=2)
    for streamed, want, columns in (
        (J.stream_packet_features(packets), R.packet_features(batch), ("packet_no", "packet_count_ip", "unique_ports")),
        (J.stream_flow_bytes(packets), R.flow_bytes(batch), ("packet_no", "flow_bytes")),
        (J.stream_rate_limit(packets, low), R.rate_limited(batch, "packet_no", low), ("packet_no", "in_window")),
    ):
        assert "[slot#" in streamed._jdf.queryExecution().analyzed().toString()
        plain = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
        assert plain(drained(streamed, "many")) == plain(want)


def test_streamed_json_lines_are_parsed_above_the_generator(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"src_ip": "a", "size": 1}\n\n{"src_ip": "b", "size": 2}\r\n')
    (tmp_path / "b.json").write_text(' [{"src_ip": "c", "size": 3}]')
    files = spark.read.text(str(tmp_path), wholetext=True).withColumn("path", F.substring_index(F.input_file_name(), "/", -1))
    rows = _json_stream(files).select("path", "pos", "packet.src_ip", "packet.size")
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("a.json", 0, "a", 1), ("a.json", 1, "b", 2), ("b.json", 0, "c", 3)]
    plan = rows.filter("size > 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and "lambdafunction(from_json(" not in plan


def test_state_is_compacted_with_each_batch(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.compactOnCommit"
    before = spark.conf.get(name, None)
    with _rocksdb(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
