"""Path and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewarden.catalog.registry import query
from tracewarden.catalog.log_queries import _contains_any, entries
from tracewarden.catalog.views import view
from tracewarden.functions import patterns as P
from tracewarden.operators import graph as G
from tracewarden.operators import paths, stats

_ENTRIES = ["entries"]
_EDGES = ["edges"]

_TOKENS = """
, toks AS (SELECT endpoint, seq, trim(endpoint, '/') AS p,
  CASE WHEN trim(endpoint, '/') = '' THEN [] ELSE string_split(trim(endpoint, '/'), '/') END AS t FROM entries)
, prefixes AS (
  SELECT array_to_string(t[1:i], '/') AS prefix, i AS depth, count(*) AS count, bool_or(i = len(t)) AS is_end
  FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM toks) GROUP BY 1, 2)"""
_PROBES = """
, probes AS (SELECT DISTINCT endpoint AS probe FROM entries
  UNION SELECT DISTINCT concat(endpoint, '/x') FROM entries
  UNION SELECT DISTINCT regexp_replace(endpoint, '/[^/]*$', '') FROM entries)"""


def _probes(spark, sf_dir):
    """Whole paths, paths that do not occur, and parents."""
    known = entries(spark, sf_dir).select("endpoint").distinct()
    return known.select(F.explode(F.array(
        F.col("endpoint"), F.concat("endpoint", F.lit("/x")),
        F.regexp_replace("endpoint", "/[^/]*$", ""),
    )).alias("probe")).distinct()


@query("path_prefix_counts", _TOKENS + """
SELECT prefix, CAST(depth AS INT) AS depth, count, is_end FROM prefixes""", _ENTRIES)
def _(spark, sf_dir):
    return paths.prefix_counts(entries(spark, sf_dir))


@query("path_search", _TOKENS + _PROBES + """
SELECT probe, trim(probe, '/') IN (SELECT p FROM toks) AS found FROM probes""", _ENTRIES)
def _(spark, sf_dir):
    return paths.search(_probes(spark, sf_dir), entries(spark, sf_dir))


@query("path_starts_with", _TOKENS + _PROBES + """
SELECT probe, trim(probe, '/') = '' OR trim(probe, '/') IN (SELECT prefix FROM prefixes) AS found FROM probes""", _ENTRIES)
def _(spark, sf_dir):
    return paths.starts_with(_probes(spark, sf_dir), entries(spark, sf_dir))


@query("path_get_count", _TOKENS + _PROBES + """
SELECT probe, coalesce(count, 0) AS count FROM probes LEFT JOIN prefixes ON prefix = trim(probe, '/')""", _ENTRIES)
def _(spark, sf_dir):
    return paths.get_count(_probes(spark, sf_dir), entries(spark, sf_dir))


@query("path_all", "SELECT DISTINCT '/' || trim(endpoint, '/') AS path FROM entries", _ENTRIES)
def _(spark, sf_dir):
    return paths.all_paths(entries(spark, sf_dir))


@query("path_suspicious", f"""
SELECT DISTINCT '/' || trim(endpoint, '/') AS path FROM entries
WHERE {_contains_any("'/' || trim(endpoint, '/')", P.SUSPICIOUS_PATH_PARTS)}""", _ENTRIES)
def _(spark, sf_dir):
    return paths.suspicious(entries(spark, sf_dir))


@query("path_depth_distribution", _TOKENS + """
SELECT CAST(depth AS INT) AS depth, count(*) AS paths FROM (SELECT DISTINCT p, len(t) AS depth FROM toks) GROUP BY 1""", _ENTRIES)
def _(spark, sf_dir):
    return paths.depth_distribution(entries(spark, sf_dir))


@query("path_data", """
SELECT '/' || trim(endpoint, '/') AS path, last(status ORDER BY seq) AS data, count(*) AS insertions
FROM entries GROUP BY 1""", _ENTRIES)
def _(spark, sf_dir):
    return paths.path_data(entries(spark, sf_dir), F.col("status"), "seq")


# -- graph ------------------------------------------------------------------------------------


def access_edges(spark, sf_dir):
    return G.edges(entries(spark, sf_dir), "ip", "endpoint", "seq")


def sample_edges(spark, sf_dir):
    return view(spark, sf_dir, "edges")


_ACCESS = ", g AS (SELECT ip AS src, endpoint AS dst, count(*) AS weight, min(seq) AS first_seq FROM entries GROUP BY 1, 2)"
_NODES = """
, ranked AS (SELECT node, min(r) AS rank FROM (
  SELECT src AS node, first_seq * 2 AS r FROM edges UNION ALL SELECT dst, first_seq * 2 + 1 FROM edges) GROUP BY node)"""


@query("graph_edges", _ACCESS + "\nSELECT src, dst, weight, first_seq FROM g", _ENTRIES)
def _(spark, sf_dir):
    return access_edges(spark, sf_dir).select("src", "dst", "weight", "first_seq")


@query("graph_edges_undirected", """
SELECT src, dst, CAST(sum(weight) AS BIGINT) AS weight, min(first_seq) AS first_seq FROM (
  SELECT src, dst, weight, first_seq FROM edges UNION ALL SELECT dst, src, weight, first_seq FROM edges)
GROUP BY src, dst""", _EDGES)
def _(spark, sf_dir):
    e = sample_edges(spark, sf_dir)
    return G.edges(e, "src", "dst", "first_seq", F.col("weight"), directed=False).select(
        "src", "dst", "weight", "first_seq")


@query("graph_nodes", _ACCESS + """
SELECT node, min(r) AS rank FROM (
  SELECT src AS node, first_seq * 2 AS r FROM g UNION ALL SELECT dst, first_seq * 2 + 1 FROM g) GROUP BY node""", _ENTRIES)
def _(spark, sf_dir):
    return G.nodes(access_edges(spark, sf_dir))


@query("graph_node_data", """
SELECT ip AS node, last(user_agent ORDER BY seq) AS data FROM entries GROUP BY ip""", _ENTRIES)
def _(spark, sf_dir):
    return G.node_data(entries(spark, sf_dir).select(
        F.col("ip").alias("node"), F.col("user_agent").alias("data"), "seq"))


@query("graph_neighbors", _ACCESS + "\nSELECT DISTINCT dst AS neighbor FROM g WHERE src = '10.0.22.0'", _ENTRIES)
def _(spark, sf_dir):
    return G.neighbors(access_edges(spark, sf_dir), "10.0.22.0")


@query("edge_weight", """
, probes AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)
SELECT src, dst, coalesce(weight, 0) AS weight FROM probes LEFT JOIN edges USING (src, dst)""", _EDGES)
def _(spark, sf_dir):
    e = sample_edges(spark, sf_dir)
    turned = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return G.edge_weight(e.select("src", "dst").union(turned).distinct(), e)


_DEGREES = _ACCESS + """
, deg AS (SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(w) AS BIGINT) AS weight_out
  FROM (SELECT src AS node, 1 AS o, 0 AS i, weight AS w FROM g UNION ALL SELECT dst, 0, 1, 0 FROM g) GROUP BY node)"""


@query("out_degree", _DEGREES + "\nSELECT node, out_degree FROM deg", _ENTRIES)
def _(spark, sf_dir):
    return G.out_degree(access_edges(spark, sf_dir))


@query("in_degree", _DEGREES + "\nSELECT node, in_degree FROM deg", _ENTRIES)
def _(spark, sf_dir):
    return G.in_degree(access_edges(spark, sf_dir))


@query("weight_out", _DEGREES + "\nSELECT node, weight_out FROM deg", _ENTRIES)
def _(spark, sf_dir):
    return G.weight_out(access_edges(spark, sf_dir))


@query("high_degree_nodes", _DEGREES + "\nSELECT node, out_degree FROM deg WHERE out_degree >= 10", _ENTRIES)
def _(spark, sf_dir):
    return G.high_degree_nodes(access_edges(spark, sf_dir))


@query("heavy_edges", _ACCESS + "\nSELECT src, dst, weight FROM g WHERE weight >= 5", _ENTRIES)
def _(spark, sf_dir):
    return G.heavy_edges(access_edges(spark, sf_dir))


_REACH = _NODES + """
, reach AS (
  SELECT node AS root, node FROM ranked UNION SELECT r.root, e.dst FROM reach r JOIN edges e ON e.src = r.node)
, comps AS (
  SELECT v.node, (SELECT node FROM ranked WHERE rank = v.root) AS component FROM (
    SELECT reach.node, min(k.rank) AS root FROM reach JOIN ranked k ON k.node = reach.root GROUP BY reach.node) v)"""


def _recursive(views, sql):
    """Mark the WITH clause recursive."""
    from tracewarden.catalog.views import with_clause

    return f"WITH RECURSIVE {with_clause(views, 'duckdb')}\n{sql.strip()}"


@query("graph_statistics", _recursive(_EDGES, _REACH + """
SELECT (SELECT count(*) FROM ranked) AS nodes, CAST((SELECT sum(weight) FROM edges) AS BIGINT) AS edges,
  (SELECT count(*) FROM edges) / CAST((SELECT count(*) FROM ranked) AS DOUBLE) AS avg_degree,
  (SELECT max(d) FROM (SELECT count(*) AS d FROM edges GROUP BY src)) AS max_degree,
  CAST((SELECT min(d) FROM (SELECT count(e.src) AS d FROM ranked LEFT JOIN edges e ON e.src = node GROUP BY node)) AS BIGINT) AS min_degree,
  (SELECT count(DISTINCT component) FROM comps) AS components"""))
def _(spark, sf_dir):
    return G.graph_statistics(sample_edges(spark, sf_dir))


@query("access_graph_statistics", _ACCESS + """
, n AS (SELECT count(DISTINCT src) AS ips, count(DISTINCT dst) AS ends, count(*) AS pairs, CAST(sum(weight) AS BIGINT) AS added FROM g)
SELECT ips + ends AS nodes, added AS edges, pairs / CAST(ips + ends AS DOUBLE) AS avg_degree,
  (SELECT max(d) FROM (SELECT count(*) AS d FROM g GROUP BY src)) AS max_degree,
  CAST(0 AS INT) AS min_degree, ips AS components FROM n""", _ENTRIES)
def _(spark, sf_dir):
    return stats.access_graph_statistics(entries(spark, sf_dir))


@query("bfs", _recursive(_EDGES, """
, walk AS (
  SELECT * FROM (SELECT src AS node, 0 AS depth FROM edges ORDER BY first_seq LIMIT 1)
  UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.depth < 200)
SELECT node, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY node"""))
def _(spark, sf_dir):
    e = sample_edges(spark, sf_dir)
    first = e.orderBy("first_seq").first()
    return G.bfs(e, first["src"] if first else "").select("node", "depth")


@query("components_directed", _recursive(_EDGES, _REACH + "\nSELECT node, component FROM comps"))
def _(spark, sf_dir):
    return G.components_directed(sample_edges(spark, sf_dir))


@query("components_weak", _recursive(_EDGES, _NODES + """
, both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)
, reach AS (
  SELECT node AS root, node FROM ranked UNION SELECT r.root, e.dst FROM reach r JOIN both_ways e ON e.src = r.node)
SELECT v.node, (SELECT node FROM ranked WHERE rank = v.root) AS component FROM (
  SELECT reach.node, min(k.rank) AS root FROM reach JOIN ranked k ON k.node = reach.root GROUP BY reach.node) v"""))
def _(spark, sf_dir):
    return G.components_weak(sample_edges(spark, sf_dir))
