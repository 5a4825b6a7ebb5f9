"""JSON arrays in small blocks against the json module."""

import json
import random

import pytest

from tracewarden.sources import packets as S
from tracewarden.sources.json_arrays import array_objects


@pytest.fixture(params=[64, 300, 1 << 20])
def small_blocks(spark, request):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, (request.param, 0, 1)):
        spark.conf.set(n, str(v))
    yield request.param
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def odd(rnd, depth=0):
    text = lambda: "".join(rnd.choice(['}', '{', '"', "\\", "a", "é", "[", "]", ",", " ", "\n", "😀", '\\"}']) for _ in range(rnd.randrange(8)))
    if depth < 3 and rnd.random() < 0.4:
        return {text(): odd(rnd, depth + 1) for _ in range(rnd.randrange(3))}
    return rnd.choice([text(), text(), 1, -2.5, None, True, [], [{}, {"x": "}"}], {}])


@pytest.mark.parametrize("seed", range(3))
def test_objects(spark, tmp_path, small_blocks, seed):
    rnd, want = random.Random(seed), []
    for f in range(3):
        rows = [{"k": odd(rnd), "n": i, **{f"m{j}": odd(rnd) for j in range(rnd.randrange(3))}} for i in range(rnd.randrange(40))]
        want += rows
        (tmp_path / f"{f}.json").write_text(json.dumps(rows, indent=rnd.choice([None, None, 2]), ensure_ascii=rnd.random() < 0.5) + "\n" * f)
    (tmp_path / "empty.json").write_text(" [ ] ")
    objects = array_objects(spark, str(tmp_path))
    got = objects.orderBy("seq").collect()
    assert [json.loads(r.text) for r in got] == want
    if small_blocks == 64:
        assert objects.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": 2', '[{"a": 1}, {"a": "x}', '[{"a": 1},', '[{"a": 1}', '[', '{"a": 1}', '[{"a": 1}]]',
                                  '[1, {"a": 1}]', '[{"a": 1} {"a": 2}]', '[{"a": {"b": 1}]'])
def test_broken_files_raise(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('[{"a": 1}]')
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        array_objects(spark, str(tmp_path)).collect()


def test_packets(spark, tmp_path, small_blocks):
    rows = [{"src_ip": f"h{i}", "dst_ip": "}\\\"{", "dst_port": i, "protocol": "TCP", "size": 40 + i, "timestamp": 1.5 + i, "more": {"x": i}}
            for i in range(200)]
    (tmp_path / "p.json").write_text(json.dumps(rows))
    packets = S.packet_scan(spark, str(tmp_path / "p.json")).orderBy("seq").collect()
    assert [(r.src_ip, r.dst_ip, r.dst_port, r.size, r.ts) for r in packets] == [
        (r["src_ip"], r["dst_ip"], r["dst_port"], r["size"], r["timestamp"]) for r in rows]
