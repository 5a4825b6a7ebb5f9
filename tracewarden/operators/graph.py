"""Graph operators over an edge table ``src, dst, weight, first_seq``.

Nodes are ranked by insertion: an edge inserts its source, then its target. The rank
``2 * first_seq + side`` is unique, so the loops below work on one BIGINT per node.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewarden.plans.skew import HOT_ROWS, hot_keys, split_join
from tracewarden.session import cut_lineage


def edges(df: DataFrame, src: str, dst: str, order: str, weight: Column | None = None,
          directed: bool = True) -> DataFrame:
    """Distinct edges with summed weight, and how often and when each was added as written.

    Undirected adds the weight of each edge to its reverse too (so a loop counts twice).
    """
    calls = df.select(
        F.col(src).alias("src"), F.col(dst).alias("dst"),
        (F.lit(1) if weight is None else weight).cast("bigint").alias("weight"),
        F.col(order).alias("first_seq"),
        F.lit(1).cast("bigint").alias("calls"),
        F.col(order).alias("added_seq"),
    )
    if not directed:
        calls = calls.unionByName(calls.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", "first_seq",
            F.lit(0).cast("bigint").alias("calls"), F.lit(None).cast("bigint").alias("added_seq"),
        ))
    return calls.groupBy("src", "dst").agg(
        F.sum("weight").alias("weight"), F.min("first_seq").alias("first_seq"),
        F.sum("calls").alias("calls"), F.min("added_seq").alias("added_seq"))


def nodes(e: DataFrame, isolated: DataFrame | None = None) -> DataFrame:
    """``node, rank``. ``isolated(node, first_seq)`` adds nodes without edges."""
    seq = F.col("added_seq" if "added_seq" in e.columns else "first_seq")
    ends = e.filter(seq.isNotNull()).select(F.inline(F.array(
        F.struct(F.col("src").alias("node"), (seq * 2).alias("rank")),
        F.struct(F.col("dst").alias("node"), (seq * 2 + 1).alias("rank")),
    )))
    if isolated is not None:
        ends = ends.unionByName(isolated.select("node", (F.col("first_seq") * 2).alias("rank")))
    return ends.groupBy("node").agg(F.min("rank").alias("rank"))


def node_data(writes: DataFrame) -> DataFrame:
    """``node, data`` from ``writes(node, data, seq)``: the last write that is not empty."""
    return writes.filter(F.col("data").isNotNull()).groupBy("node").agg(F.max_by("data", "seq").alias("data"))


def neighbors(e: DataFrame, node: str) -> DataFrame:
    return e.filter(F.col("src") == node).select(F.col("dst").alias("neighbor")).distinct()


def edge_weight(probes: DataFrame, e: DataFrame) -> DataFrame:
    """``probes(src, dst)`` with their weight, 0 where there is no edge."""
    return probes.join(e.select("src", "dst", "weight"), ["src", "dst"], "left").withColumn(
        "weight", F.coalesce("weight", F.lit(0)).cast("bigint"))


def degrees(e: DataFrame, isolated: DataFrame | None = None) -> DataFrame:
    """``node, out_degree, in_degree, weight_out`` for every node, in one aggregation; ``isolated(node)`` adds nodes."""
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    ends = e.select(F.inline(F.array(
        F.struct(F.col("src").alias("node"), one.alias("o"), zero.alias("i"), F.col("weight").alias("w")),
        F.struct(F.col("dst").alias("node"), zero.alias("o"), one.alias("i"), zero.alias("w")),
    )))
    if isolated is not None:
        ends = ends.unionByName(isolated.select("node", zero.alias("o"), zero.alias("i"), zero.alias("w")))
    return ends.groupBy("node").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum("w").alias("weight_out"))


def out_degree(e: DataFrame) -> DataFrame:
    return degrees(e).select("node", "out_degree")


def in_degree(e: DataFrame) -> DataFrame:
    return degrees(e).select("node", "in_degree")


def weight_out(e: DataFrame) -> DataFrame:
    return degrees(e).select("node", "weight_out")


def high_degree_nodes(e: DataFrame, threshold: int = 10) -> DataFrame:
    return out_degree(e).filter(F.col("out_degree") >= threshold).orderBy(F.desc("out_degree"), "node")


def heavy_edges(e: DataFrame, threshold: int = 5) -> DataFrame:
    return e.select("src", "dst", "weight").filter(F.col("weight") >= threshold).orderBy(
        F.desc("weight"), "src", "dst")


def _ranked_edges(e: DataFrame, n: DataFrame) -> DataFrame:
    """Edges between node ranks, ``a → b``, without loops."""
    source = n.select(F.col("node").alias("src"), F.col("rank").alias("a"))
    target = n.select(F.col("node").alias("dst"), F.col("rank").alias("b"))
    total = e.count()
    half = split_join(e.select("src", "dst"), source, ["src"], ["dst"], total=total)
    both = split_join(half, target, ["dst"], ["a"], total=total)
    return both.select("a", "b").filter(F.col("a") != F.col("b"))


#: A level of a walk with so many nodes is numbered by one task; a larger one by ranges of its order.
LEVEL_ROWS = 100_000


def bfs(e: DataFrame, start: str) -> DataFrame:
    """``node, depth, rank`` of the nodes reachable from ``start``.

    ``orderBy('depth', 'rank')`` is the visiting order: inside a level a node comes at its earliest parent, and under one parent
    in the order in which the edges were added. Ranks ascend in a level and need not be dense; a row stays three columns wide,
    however deep the walk. Each level is a job. An unknown start gives no rows.
    """
    out = cut_lineage(e.select("src", "dst", "first_seq"))
    total = out.count()
    hot = cut_lineage(hot_keys(out, ["src"])) if total > HOT_ROWS else None
    zero = F.lit(0).cast("bigint")
    frontier = cut_lineage(nodes(e).filter(F.col("node") == start).select("node", F.lit(0).alias("depth"), zero.alias("rank")))
    seen, size = frontier, frontier.count()
    for depth in count(1):
        if not size:
            return seen
        step = split_join(
            out, frontier.select(F.col("node").alias("src"), F.col("rank").alias("parent")), ["src"], ["dst"], hot=hot, total=total)
        reached = step.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("parent", "first_seq")).alias("at"))
        found = cut_lineage(reached.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)))
        size = found.count()
        if size <= LEVEL_ROWS:
            frontier = found.select("node", "depth", F.row_number().over(W.orderBy("at")).cast("bigint").alias("rank"))
        else:
            # Numbers that ascend over the ranges and inside each; kept, since they depend on how the ranges fell.
            ranges = found.repartitionByRange("at").sortWithinPartitions("at")
            frontier = cut_lineage(ranges.select("node", "depth", F.monotonically_increasing_id().alias("rank")))
        seen = seen.unionByName(frontier)
        if depth % 16 == 0:
            seen = cut_lineage(seen)


def _spread_minimum(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """``rank, root``: the smallest rank from which each node can be reached over ``links(a, b)``.

    Each round a node takes the smallest root among itself, the sources of its incoming links, and the
    root of its present root. The last step is sound, since reachability is transitive, and it shortens
    long chains: the distance covered can double each round.
    """
    links = cut_lineage(links)
    n_links, n_nodes = links.count(), ranks.count()
    hot = cut_lineage(hot_keys(links, ["a"])) if n_links > HOT_ROWS else None
    state = cut_lineage(ranks.select("rank", F.col("rank").alias("root"), F.lit(True).alias("changed")))
    while True:
        # Only nodes that changed can improve their neighbours.
        moved = state.filter("changed").select(F.col("rank").alias("a"), "root")
        offers = split_join(links, moved, ["a"], ["b"], hot=hot, total=n_links).select(
            F.col("b").alias("rank"), "root")
        # Only a root that has a smaller root of its own can improve those who point to it.
        lower = state.filter(F.col("root") < F.col("rank")).select(
            F.col("rank").alias("via"), F.col("root").alias("root"))
        jumps = split_join(
            state.select("rank", F.col("root").alias("via")).filter(F.col("via") < F.col("rank")),
            lower, ["via"], ["rank"], total=n_nodes).select("rank", "root")
        best = offers.unionByName(jumps).groupBy("rank").agg(F.min("root").alias("offer"))
        state = cut_lineage(
            state.select("rank", "root").join(best, "rank", "left").select(
                "rank",
                F.least("root", F.coalesce("offer", "root")).alias("root"),
                F.coalesce(F.col("offer") < F.col("root"), F.lit(False)).alias("changed"),
            ))
        if state.filter("changed").isEmpty():
            return state.select("rank", "root")


def _named_roots(assigned: DataFrame, n: DataFrame) -> DataFrame:
    named = assigned.join(n, "rank")
    roots = n.select(F.col("rank").alias("root"), F.col("node").alias("component"))
    return split_join(named, roots, ["root"], ["rank"], total=n.count()).select("node", "component")


def components_directed(e: DataFrame, isolated: DataFrame | None = None) -> DataFrame:
    """``node, component``: the earliest-inserted node from which the node can be reached.

    These are the groups found by walking out-edges from the nodes in insertion order; they are
    not strongly or weakly connected components.
    """
    e = cut_lineage(e)
    n = cut_lineage(nodes(e, isolated))
    return _named_roots(_spread_minimum(_ranked_edges(e, n), n), n)


def components_weak(e: DataFrame, isolated: DataFrame | None = None) -> DataFrame:
    """``node, component``: connected components, named by their earliest-inserted node.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until the links are stars.
    """
    e = cut_lineage(e)
    n = cut_lineage(nodes(e, isolated))
    links = cut_lineage(_ranked_edges(e, n).select(
        F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    while True:
        total, tangled = _shape(links)
        if not tangled:
            break
        links = cut_lineage(_small_star(cut_lineage(_large_star(links, total)), total))
    # Every node is now linked to its component's smallest rank, and to nothing else.
    members = links.select(F.col("high").alias("rank"), F.col("low").alias("root"))
    alone = n.select("rank").join(members, "rank", "left_anti")
    return _named_roots(
        members.unionByName(alone.select("rank", F.col("rank").alias("root"))), n)


def _shape(links: DataFrame) -> tuple[int, int]:
    """The number of links, and of nodes that keep them from being separate stars: nodes with links
    both ways, or with more than one smaller node."""
    one, zero = F.lit(1), F.lit(0)
    ends = links.select(F.inline(F.array(
        F.struct(F.col("low").alias("node"), zero.alias("smaller"), one.alias("larger")),
        F.struct(F.col("high").alias("node"), one.alias("smaller"), zero.alias("larger")),
    )))
    per_node = ends.groupBy("node").agg(F.sum("smaller").alias("s"), F.sum("larger").alias("l"))
    row = per_node.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("total"),
        F.count_if((F.col("s") > 1) | ((F.col("s") > 0) & (F.col("l") > 0))).alias("tangled"),
    ).first()
    return row["total"], row["tangled"]


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    around = links.select(F.inline(F.array(
        F.struct(F.col("low").alias("u"), F.col("high").alias("v")),
        F.struct(F.col("high").alias("u"), F.col("low").alias("v")),
    )))
    smallest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = around.filter(F.col("v") > F.col("u"))
    return split_join(larger, smallest, ["u"], ["v"], total=2 * total).select(
        F.col("m").alias("low"), F.col("v").alias("high")).distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("high").agg(F.min("low").alias("m"))
    moved = split_join(links, smallest, ["high"], ["low"], total=2 * total)
    return moved.select(F.inline(F.array(
        F.struct(F.col("m").alias("low"), F.col("low").alias("high")),
        F.struct(F.col("m").alias("low"), F.col("high").alias("high")),
    ))).filter(F.col("low") < F.col("high")).distinct()


def graph_statistics(e: DataFrame, components: DataFrame | None = None, isolated: DataFrame | None = None) -> DataFrame:
    """One row. ``edges`` counts the edges as added, repeats included; ``isolated(node, first_seq)`` adds nodes without edges. An
    empty graph has 0 nodes and 0 edges, and its other values are NULL."""
    parts = components_directed(e, isolated) if components is None else components
    count = parts.agg(F.count_distinct("component").alias("n")).scalar()
    calls = "calls" if "calls" in e.columns else "weight"
    added = e.agg(F.coalesce(F.sum(calls), F.lit(0)).alias("n")).scalar()
    return degrees(e, isolated).agg(
        F.count(F.lit(1)).alias("nodes"),
        added.alias("edges"),
        F.avg("out_degree").alias("avg_degree"),
        F.max("out_degree").alias("max_degree"),
        F.min("out_degree").alias("min_degree"),
        count.alias("components"),
    ).withColumn("components", F.when(F.col("nodes") > 0, F.col("components")))
