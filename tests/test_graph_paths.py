"""Path and graph operators against naive walks."""

import random

import pytest
from pyspark.sql import functions as F

from tracewarden.operators import graph as G
from tracewarden.operators import paths as P


def path_frame(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "endpoint string, seq long")


PATHS = ["/a/b", "a/b/", "/a//b", "/", "", "/a", "//a/b//", "/x?y=/z"]


def test_prefixes(spark):
    got = {(r.prefix, r.depth): (r["count"], r.is_end) for r in P.prefix_counts(path_frame(spark, PATHS)).collect()}
    assert got == {
        ("a", 1): (5, True), ("a/b", 2): (3, True), ("a/", 2): (1, False), ("a//b", 3): (1, True),
        ("x?y=", 1): (1, False), ("x?y=/z", 2): (1, True),
    }


def test_probes(spark):
    probes = spark.createDataFrame([(p,) for p in ("/a/b/", "/a/", "/x?y=", "/", "/zz")], "probe string")
    data = path_frame(spark, PATHS)
    as_map = lambda df, c: {r.probe: r[c] for r in df.collect()}
    assert as_map(P.search(probes, data), "found") == {"/a/b/": True, "/a/": True, "/x?y=": False, "/": True, "/zz": False}
    assert as_map(P.starts_with(probes, data), "found") == {"/a/b/": True, "/a/": True, "/x?y=": True, "/": True, "/zz": False}
    assert as_map(P.get_count(probes, data), "count") == {"/a/b/": 3, "/a/": 5, "/x?y=": 1, "/": 0, "/zz": 0}
    # Without data the empty prefix still starts every path.
    assert as_map(P.starts_with(probes, data.limit(0)), "found")["/"] is True


def test_path_sets(spark):
    data = path_frame(spark, PATHS + ["/fetch", "/ETC/x", "/a.git"])
    assert {r.path for r in P.all_paths(data).collect()} == {
        "/a/b", "/a//b", "/", "/a", "/x?y=/z", "/fetch", "/ETC/x", "/a.git"}
    assert {r.path for r in P.suspicious(data).collect()} == {"/fetch", "/a.git"}
    assert {r.depth: r.paths for r in P.depth_distribution(path_frame(spark, PATHS)).collect()} == {0: 1, 1: 1, 2: 2, 3: 1}
    kept = P.path_data(data, F.col("seq"), "seq").filter("path = '/a/b'").first()
    assert (kept.data, kept.insertions) == (6, 3)


def random_calls(seed, nodes=12, calls=18):
    rnd = random.Random(seed)
    return [(f"n{rnd.randrange(nodes)}", f"n{rnd.randrange(nodes)}", i) for i in range(calls)]


class Naive:
    """Adjacency in insertion order, as a plain dict of dicts."""

    def __init__(self, calls, directed=True):
        self.out = {}
        for a, b, _ in calls:
            self.out.setdefault(a, {})
            self.out.setdefault(b, {})
            self.out[a][b] = self.out[a].get(b, 0) + 1
            if not directed:
                self.out[b][a] = self.out[b].get(a, 0) + 1

    def bfs(self, start):
        order, queue = [], [start]
        while queue:
            node = queue.pop(0)
            if node not in order:
                order.append(node)
                queue += self.out[node]
        return order

    def components(self):
        owner = {}
        for root in self.out:
            stack = [root] if root not in owner else []
            while stack:
                node = stack.pop()
                if node not in owner:
                    owner[node] = root
                    stack += self.out[node]
        return owner


def edge_frame(spark, calls, directed=True):
    return G.edges(spark.createDataFrame(calls, "s string, d string, o long"), "s", "d", "o", directed=directed)


@pytest.mark.parametrize("seed", range(2))
def test_against_walks(spark, seed):
    calls = random_calls(seed)
    e, naive = edge_frame(spark, calls), Naive(calls)
    start = calls[0][0]
    assert [r.node for r in G.bfs(e, start).orderBy("depth", "rank").collect()] == naive.bfs(start)
    assert {r.node: r.component for r in G.components_directed(e).collect()} == naive.components()
    assert {r.node: r.component for r in G.components_weak(e).collect()} == Naive(calls, False).components()
    both = edge_frame(spark, calls, directed=False)
    assert {(r.src, r.dst): r.weight for r in both.collect()} == {
        (a, b): w for a, bs in Naive(calls, False).out.items() for b, w in bs.items()}
    assert [r.node for r in G.nodes(both).orderBy("rank").collect()] == list(naive.out)
    row = G.graph_statistics(e).first()
    sizes = [len(v) for v in naive.out.values()]
    assert (row.nodes, row.edges, row.max_degree, row.min_degree) == (len(sizes), len(calls), max(sizes), min(sizes))
    assert row.components == len(set(naive.components().values()))
    assert row.avg_degree == pytest.approx(sum(sizes) / len(sizes))


def test_split_keys_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(G, "HOT_ROWS", 3)
    original = G.split_join
    monkeypatch.setattr(G, "split_join", lambda *a, **k: original(*a, **{**k, "hot_rows": 3}))
    calls = random_calls(9, 20, 30) + [("n0", f"m{i}", 100 + i) for i in range(15)]
    e = edge_frame(spark, calls)
    assert {r.node: r.component for r in G.components_directed(e).collect()} == Naive(calls).components()
    assert {r.node: r.component for r in G.components_weak(e).collect()} == Naive(calls, False).components()
    start = calls[0][0]
    assert [r.node for r in G.bfs(e, start).orderBy("depth", "rank").collect()] == Naive(calls).bfs(start)


def test_long_chain_needs_few_rounds(spark, monkeypatch):
    rounds, star = [], G._large_star
    monkeypatch.setattr(G, "_large_star", lambda *a: rounds.append(1) or star(*a))
    calls = [(f"c{i:03d}", f"c{i + 1:03d}", i) for i in range(60)]
    e = edge_frame(spark, calls)
    assert G.components_directed(e).select("component").distinct().count() == 1
    assert G.components_weak(e).select("component").distinct().count() == 1
    assert len(rounds) <= 9


def test_small_cases(spark):
    e = edge_frame(spark, [("a", "a", 0), ("a", "b", 1), ("a", "b", 2), ("c", "b", 3)])
    assert G.bfs(e, "unknown").count() == 0
    alone = spark.createDataFrame([("z", 9)], "node string, first_seq long")
    assert {r.node: r.component for r in G.components_weak(e, alone).collect()} == {"a": "a", "b": "a", "c": "a", "z": "z"}
    assert {r.node: (r.out_degree, r.in_degree, r.weight_out) for r in G.degrees(e).collect()} == {
        "a": (2, 1, 3), "b": (0, 2, 0), "c": (1, 0, 1)}
    loop = edge_frame(spark, [("a", "a", 0)], directed=False).first()
    assert (loop.weight, loop.calls) == (2, 1)
    probes = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    assert sorted(tuple(r) for r in G.edge_weight(probes, e).collect()) == [("a", "b", 2), ("b", "a", 0)]
    assert [tuple(r) for r in G.graph_statistics(e.limit(0)).collect()] == [(0, 0, None, None, None, None)]
    assert tuple(G.graph_statistics(e.limit(0), isolated=alone).first()) == (1, 0, 0.0, 0, 0, 1)
    assert tuple(G.graph_statistics(e, isolated=alone).first()) == (4, 4, 0.75, 2, 0, 3)
    data = spark.createDataFrame([("a", "x", 0), ("a", None, 1)], "node string, data string, seq long")
    assert G.node_data(data).first().data == "x"


def test_walks_of_large_levels(spark, monkeypatch):
    calls = random_calls(4, 30, 60)
    e = edge_frame(spark, calls)
    monkeypatch.setattr(G, "LEVEL_ROWS", 2)
    assert [r.node for r in G.bfs(e, calls[0][0]).orderBy("depth", "rank").collect()] == Naive(calls).bfs(calls[0][0])
    star = spark.range(300_000).select(
        F.lit("hub").alias("src"), F.concat(F.lit("leaf"), F.col("id").cast("string")).alias("dst"), F.lit(1).alias("weight"),
        ((F.col("id") * 7919) % 300_000).alias("first_seq"))
    monkeypatch.setattr(G, "LEVEL_ROWS", 1000)
    order = G.bfs(star, "hub").filter("depth = 1").join(star, F.col("node") == F.col("dst")).orderBy("rank").select("first_seq")
    assert [r[0] for r in order.collect()] == list(range(300_000))
