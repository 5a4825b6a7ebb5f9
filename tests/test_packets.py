"""Packet sources, alerts, classifier, flows and byte features."""

import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tracewarden.operators import alerts as A
from tracewarden.operators import byte_features as B
from tracewarden.operators import classify as C
from tracewarden.operators import flow_features as L
from tracewarden.operators import keyed
from tracewarden.operators import running_features as R
from tracewarden.schema import MODEL_COLUMNS
from tracewarden.sources import packets as S

FIELDS = ["src_ip", "dst_ip", "dst_port", "protocol", "size", "timestamp"]


def test_csv_by_name(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("size,src_ip,dst_ip,timestamp,dst_port,protocol\n40,a,b,1.5,22,TCP\n")
    row = S.packet_scan(spark, str(path)).drop("seq").first()
    assert row.asDict() == {"src_ip": "a", "dst_ip": "b", "dst_port": 22, "protocol": "TCP", "size": 40, "ts": 1.5}
    path.write_text("src_ip,dst_ip,dst_port,protocol,size,timestamp\na,b,http,TCP,40,1\n")
    with pytest.raises(PySparkException):
        S.packet_scan(spark, str(path)).collect()


def test_json_array_and_lines(spark, tmp_path):
    rows = [dict(zip(FIELDS, ("a", "b", i, "TCP", 40, 1.0 + i))) for i in range(3)]
    (tmp_path / "p.json").write_text(json.dumps(rows))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    for df in (S.packet_scan(spark, str(tmp_path / "p.json")),
               S.packets_from_json(spark, str(tmp_path / "lines.json"), lines=True)):
        assert [r.dst_port for r in df.orderBy("seq").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        S.packet_scan(spark, "p.CSV")
    # The dispatcher finds the form, and loses nothing.
    assert S.packet_scan(spark, str(tmp_path / "lines.json")).count() == 3
    (tmp_path / "tall.json").write_text(json.dumps(rows, indent=1))
    assert S.packet_scan(spark, str(tmp_path / "tall.json")).count() == 3
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        S.packets_from_json(spark, str(tmp_path)).collect()


def test_differing_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("src_ip,dst_ip,dst_port,protocol,size,timestamp\na,b,22,TCP,40,1\n")
    (tmp_path / "b.csv").write_text("dst_ip,src_ip,dst_port,protocol,size,timestamp\nb,a,22,TCP,40,1\n")
    with pytest.raises(Exception, match="CSV header"):
        S.packets_from_csv(spark, str(tmp_path)).collect()


def test_percentile_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    at = lambda values, q: C.exact_percentile(spark.createDataFrame([(v,) for v in values], "v double"), "v", q)
    assert at([1.0, 2.0, 3.0, nan, None], 0.5) == 2.0
    assert at([1.0, 2.0, inf], 0.5) == 2.0 and at([1.0, 2.0, inf], 1.0) == inf
    assert at([-inf, -inf, 5.0, inf], 0.25) == -inf and at([-inf, 4.0, 5.0], 0.75) == 4.5
    assert at([nan], 0.5) is None


def test_protocol_variants(spark):
    df = spark.createDataFrame([("TCP", 22), ("UDP", 53)], "protocol string, dst_port int")
    assert [tuple(r) for r in S.all_ip(df).collect()] == [("TCP", 22), ("Other", 0)]
    assert S.tcp_only(df).count() == 1


def packet_frame(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "packet_no long, src_ip string, dst_ip string, dst_port int, protocol string, size long, ts double")


def test_scan_of_one_host(spark):
    """16 ports from one host, the last packet oversized, then a quiet host."""
    rows = [("h", "d", 1000 + i, "TCP", 450 + i, float(i)) for i in range(15)]
    rows += [("h", "d", 2000, "TCP", 1600, 16.0)] + [("q", "e", 443, "TCP", 500, 20.0 + i) for i in range(5)]
    alerts = A.packet_alerts(packet_frame(spark, rows))
    assert {(r.type, r.detail) for r in alerts.collect()} == {
        ("PORT_SCAN", "Unusual port access count: 15"), ("PORT_SCAN", "Unusual port access count: 16"),
        ("SUSPICIOUS_PACKET", "Large packet size: 1600"),
        ("ML_ANOMALY", "Machine learning model flagged anomaly")}
    assert [r.severity for r in A.by_priority(alerts).collect()] == ["high"] * 3 + ["medium"]
    origin = A.alert_origin(alerts, packet_frame(spark, rows))
    assert {(r.item, r.key): r.value for r in origin.filter("item != 'port'").collect()} == {
        ("packets", ""): 16, ("flow", "d"): sum(r[4] for r in rows[:16])}
    assert origin.filter("item = 'port'").count() == 16


def test_arrival_order_not_time(spark):
    rows = [("a", "b", 1, "TCP", 10, t) for t in (5.0, 3.0, 9.0)]
    got = R.time_delta(packet_frame(spark, rows)).orderBy("packet_no").collect()
    assert [r.time_delta for r in got] == [0.0, -2.0, 6.0]


def test_rate_limit_is_inclusive(spark):
    rows = [("a", "b", 1, "TCP", 10, float(t)) for t in [0] * 30 + [60, 60.5]]
    got = R.rate_limited(packet_frame(spark, rows)).collect()
    assert [(r.ts, r.in_window) for r in got] == [(60.0, 31)]


def test_severity_case_is_ignored(spark):
    df = spark.createDataFrame([("LOW", 1), ("odd", 2), ("Critical", 3)], "severity string, seq long")
    assert [r.severity for r in A.by_priority(df).collect()] == ["Critical", "LOW", "odd"]


@pytest.mark.parametrize("values, expected", [
    (("500", "1", "0", "6", "0"), 1), (("500", "101", "0", "0", "0"), 1), (("99", "21", "0", "0", "0"), 1),
    (("100", "21", "0", "0", "0"), 0), (("500", "100", "0", "5", "0"), 0),
    ((None, "101", "0", "9", "0"), 0), (("500", "101", "x", "9", "0"), 0),
    (("NaN", "21", "0", "0", "0"), 0), (("500", "1", "0", "NaN", "0"), 0), (("500", "NaN", "0", "0", "0"), 0),
    (("99", "21"), 1), (("500", "20"), 0), (("99",), 0), ((), 0),
])
def test_rule_classifier(spark, values, expected):
    names = list(MODEL_COLUMNS[:len(values)])
    schema = ", ".join(["id int"] + [f"{n} string" for n in names])
    df = spark.createDataFrame([(1, *values)], schema)
    assert df.select(C.is_attack(names).alias("p")).first().p == expected


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 2), (3, 101), (4, 5000)])
def test_percentile_is_exact(spark, seed, n):
    rnd = random.Random(seed)
    values = [rnd.choice([rnd.gauss(0, 1e6), 7.0, -3.5]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for q in (0.05, 0.5, 0.95):
        assert C.exact_percentile(df, "v", q) == pytest.approx(np.percentile(values, q * 100), rel=1e-12)


def test_saved_model(spark, tmp_path):
    rows = [(float(i), float(i % 7), 0.0, float(i % 11), 0.0, int(i % 11 > 5)) for i in range(60)]
    data = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in MODEL_COLUMNS) + ", label int")
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(MODEL_COLUMNS), outputCol="features"),
        DecisionTreeClassifier(labelCol="label", featuresCol="features"),
    ]).fit(data)
    model.save(str(tmp_path / "model"))
    loaded = C.load_model(spark, str(tmp_path / "model"))
    assert C.model_metadata(loaded)["feature_count"] == 5
    assert C.model_score(data, loaded).filter("prediction != label").count() == 0
    with pytest.warns(UserWarning):
        missing = C.load_model(spark, str(tmp_path / "none"))
    assert C.model_score(data, missing).filter("prediction != 0").count() == 0 and C.model_metadata(missing) == {}


def test_tree_as_sql(spark):
    rnd = random.Random(5)
    rows = [tuple(rnd.choice([0.0, 1.5, -2.0, 7.25, 1e9, rnd.random()]) for _ in MODEL_COLUMNS) for _ in range(400)]
    data = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in MODEL_COLUMNS)).withColumn(
        "label", ((F.col("packet_size") > 1) != (F.col("unique_ports") > F.col("time_delta"))).cast("int"))
    model = C.fit_tree(data.unionByName(data.limit(3).withColumn("time_delta", F.lit(None).cast("double"))))
    both = C.model_score(data, model).withColumn("sql", F.expr(C.tree_sql(model)))
    assert both.filter("sql != prediction").count() == 0 and both.select("sql").distinct().count() == 2


def test_model_in_the_packet_path(spark):
    rows = [(i, "a" if i % 2 else "b", "d", 22, "TCP", 100 + i, i / 4) for i in range(30)]
    packets = packet_frame(spark, [r[1:] for r in rows])
    learned = R.packet_features(packets).withColumn("label", (F.col("packet_size") > 120).cast("int"))
    model = C.fit_tree(learned)
    found = {(r.type, r.ip) for r in A.packet_alerts(packets, model=model).collect()}
    assert ("ML_ANOMALY", "a") in found and ("ML_ANOMALY", "b") in found
    assert not any(t == "ML_ANOMALY" for t, _ in {(r.type, r.ip) for r in A.packet_alerts(packets).collect()})


def test_keyed_contains_needs_a_value(spark):
    table = spark.createDataFrame([("a", 1), ("b", None)], "key string, value int")
    probes = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert [r.key for r in keyed.contains(probes, table).collect()] == ["a"]
    assert {r.key: r.value for r in keyed.lookup(probes, table).collect()} == {"a": 1, "b": None, "c": None}


def test_two_way_flow(spark):
    rows = [("x", "a", 80, "TCP", 100, 0.0), ("a", "x", 80, "TCP", 50, 0.5), ("x", "a", 80, "TCP", 300, 1.0),
            ("a", "x", 80, "TCP", 70, 9.0), ("x", "a", 80, "UDP", 1, 0.0)]
    packets = packet_frame(spark, rows)
    got = L.flow_features(packets).filter("protocol = 'TCP'").first().asDict()
    assert got["Total Fwd Packets"] == 2 and got["Total Length of Bwd Packets"] == 120
    assert got["Fwd Packet Length Max"] == 300 and got["Bwd Packet Length Mean"] == 60
    assert got["Flow Duration"] == 9e6 and got["Flow Bytes/s"] == pytest.approx(520 / 9)
    assert got["Down/Up Ratio"] == 1 and got["Packet Length Variance"] == pytest.approx(np.var([100, 50, 300, 70], ddof=1))
    assert (got["Flow IAT Max"], got["Flow IAT Min"]) == (8e6, 5e5)
    assert (got["Fwd IAT Total"], got["Bwd IAT Total"]) == (1e6, 8.5e6)
    assert (got["Active Max"], got["Active Min"], got["Idle Mean"]) == (1e6, 0, 8e6)
    assert got["SYN Flag Count"] is None and got["Bwd Header Length"] is None
    single = L.flow_features(packets).filter("protocol = 'UDP'").first().asDict()
    assert single["Flow Bytes/s"] is None and single["Idle Mean"] is None


def test_flow_header_flags(spark):
    df = packet_frame(spark, [("x", "a", 80, "TCP", 60, 0.0), ("a", "x", 80, "TCP", 20, 1.0)]).withColumns({
        "tcp_flags": F.when(F.col("packet_no") == 0, 2).otherwise(18), "header_len": F.lit(20), "win": F.col("size")})
    got = L.flow_header_features(df).first().asDict()
    assert got["SYN Flag Count"] == 2 and got["ACK Flag Count"] == 1 and got["Fwd PSH Flags"] == 0
    assert (got["Init_Win_bytes_forward"], got["Init_Win_bytes_backward"], got["act_data_pkt_fwd"]) == (60, 20, 1)


def _slow_entropy(data):
    out = Counter()
    windows = [data] if len(data) < 2048 else [data[i:i + 2048] for i in range(0, len(data) - 2047, 1024)]
    for w in windows:
        counts = Counter(b >> 4 for b in w)
        bits = -sum(c / 2048 * math.log2(c / 2048) for c in counts.values())
        for nibble, c in counts.items():
            out[min(int(bits * 4), 15) * 16 + nibble] += c
    return {k: v for k, v in out.items()}


def test_byte_features(spark):
    rnd = random.Random(3)
    blobs = [b"", b"abc", bytes(rnd.randrange(256) for _ in range(9001)), b"x" * 2048]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "id int, content binary")
    for r in B.byte_histogram(df, "id", "content").collect():
        counts = Counter(blobs[r.id])
        assert r.counts == [counts[i] for i in range(256)]
        assert sum(r.histogram) == pytest.approx(1.0 if blobs[r.id] else 0.0)
    for r in B.byte_entropy_histogram(df, "id", "content").collect():
        if blobs[r.id]:
            assert {i: c for i, c in enumerate(r.counts) if c} == _slow_entropy(blobs[r.id])


def test_string_features(spark):
    df = spark.createDataFrame([(1, "ab\tC:\\dir http://x\x01HKEY_A MZ"), (2, "é")], "id int, text string")
    one, two = B.string_features(df, "id").orderBy("id").collect()
    assert (one.numstrings, one.paths, one.urls, one.registry, one.MZ) == (2, 1, 1, 1, 1)
    assert one.printables == len("C:\\dir http://x") + len("HKEY_A MZ")
    assert (two.numstrings, two.avlength, two.entropy) == (0, 0.0, 0.0)


def test_alerts_of_large_packet_numbers(spark):
    rows = [(2_000_000_000_000_000_000 + i, "a", "d", 22, "TCP", 2000 + i % 2, float(i)) for i in range(4)]
    packets = spark.createDataFrame(rows, "packet_no long, src_ip string, dst_ip string, dst_port int, protocol string, size long, ts double")
    found = {r.detail: (r.seq["at"], r.seq["rule"]) for r in A.packet_alerts(packets).collect()}
    assert found == {"Large packet size: 2000": (rows[0][0], 5), "Large packet size: 2001": (rows[1][0], 5)}
