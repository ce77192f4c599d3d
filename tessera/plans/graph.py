"""Graph queries.

* Event graphs: one undirected graph per (user, week) whose nodes are event types and
  whose edges join two different consecutive event types.
* Grid graphs: one per market segment of ``customer``; a node per occupied cell
  (x = nation, y = account balance in thousands), edges to the nearest node along rows,
  columns and 45-degree diagonals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources import read_table

_G = ["user_id", "week"]
#: Nodes and edges of one message of a grid graph, about; a graph of the smallest tables has more.
PART_SIZE = 32

_EV_SQL = """
ev AS (
  SELECT user_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, event_type,
         lag(event_type) OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS prev
  FROM events),
edges AS (
  SELECT DISTINCT user_id, week, least(prev, event_type) AS u, greatest(prev, event_type) AS v
  FROM ev WHERE prev IS NOT NULL AND prev <> event_type),
adj AS (SELECT user_id, week, u, v FROM edges UNION ALL SELECT user_id, week, v, u FROM edges),
nodes AS (SELECT DISTINCT user_id, week, u AS node FROM adj),
sizes AS (SELECT user_id, week, count(*) AS n_nodes FROM nodes GROUP BY ALL)"""

_CYCLES_SQL = """
paths(user_id, week, start, last, path) AS (
  SELECT user_id, week, node, node, [node] FROM nodes
  UNION ALL
  SELECT p.user_id, p.week, p.start, a.v, list_append(p.path, a.v)
  FROM paths p JOIN adj a ON a.user_id = p.user_id AND a.week = p.week AND a.u = p.last
  WHERE a.v > p.start AND NOT list_contains(p.path, a.v)),
cycles AS (
  SELECT p.user_id, p.week, CAST(len(p.path) AS INTEGER) AS length, array_to_string(p.path, '>') AS cycle
  FROM paths p JOIN adj a ON a.user_id = p.user_id AND a.week = p.week AND a.u = p.last AND a.v = p.start
  WHERE len(p.path) >= 3 AND p.path[2] < p.last)"""

_GRID_SQL = """
gnodes AS (
  SELECT c_mktsegment AS graph_id, c_nationkey AS x, CAST(floor(c_acctbal / 1000) AS INTEGER) AS y,
         min(c_custkey) AS node_id
  FROM customer GROUP BY 1, 2, 3),
ge AS (
  SELECT graph_id, node_id AS a, lead(node_id) OVER (PARTITION BY graph_id, y ORDER BY x) AS b, 'axis' AS kind FROM gnodes
  UNION ALL SELECT graph_id, node_id, lead(node_id) OVER (PARTITION BY graph_id, x ORDER BY y), 'axis' FROM gnodes
  UNION ALL SELECT graph_id, node_id, lead(node_id) OVER (PARTITION BY graph_id, x - y ORDER BY x), 'diagonal' FROM gnodes
  UNION ALL SELECT graph_id, node_id, lead(node_id) OVER (PARTITION BY graph_id, x + y ORDER BY x), 'diagonal' FROM gnodes),
gedges AS (SELECT graph_id, least(a, b) AS u, greatest(a, b) AS v, kind FROM ge WHERE b IS NOT NULL)"""


def _event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week"),
        "ts", "event_id", "event_type")
    return G.transition_edges(ev, _G, "ts", "event_id", "event_type")


def _grid_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.groupBy(F.col("c_mktsegment").alias("graph_id"), F.col("c_nationkey").alias("x"),
                     F.floor(F.col("c_acctbal") / 1000).cast("int").alias("y")) \
        .agg(F.min("c_custkey").alias("node_id"))


@register("graph_event_edges", f"""
WITH {_EV_SQL}
SELECT user_id, week, u, v FROM edges""")
def graph_event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_edges(spark, sf_dir)


@register("graph_cycles_by_user_week", f"""
WITH RECURSIVE {_EV_SQL}, {_CYCLES_SQL}
SELECT user_id, week, length, cycle FROM cycles""")
def graph_cycles_by_user_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    cyc = G.simple_cycles(_event_edges(spark, sf_dir), _G)
    return cyc.select(*_G, "length", F.concat_ws(">", "cycle").alias("cycle"))


@register("graph_hamiltonian_by_user_week", f"""
WITH RECURSIVE {_EV_SQL}, {_CYCLES_SQL}
SELECT c.user_id, c.week, c.cycle FROM cycles c JOIN sizes s USING (user_id, week)
WHERE c.length = s.n_nodes""")
def graph_hamiltonian_by_user_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    cyc = G.simple_cycles(_event_edges(spark, sf_dir), _G, hamiltonian=True)
    return cyc.select(*_G, F.concat_ws(">", "cycle").alias("cycle"))


@register("graph_hamiltonian_paths_by_user_week", f"""
WITH RECURSIVE {_EV_SQL},
hp(user_id, week, last, path) AS (
  SELECT user_id, week, node, [node] FROM nodes
  UNION ALL
  SELECT p.user_id, p.week, a.v, list_append(p.path, a.v)
  FROM hp p JOIN adj a ON a.user_id = p.user_id AND a.week = p.week AND a.u = p.last
  WHERE NOT list_contains(p.path, a.v))
SELECT user_id, week, array_to_string(path, '>') AS path
FROM hp JOIN sizes USING (user_id, week)
WHERE len(path) = n_nodes AND n_nodes >= 2 AND path[1] < path[-1]""")
def graph_hamiltonian_paths_by_user_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    hp = G.hamiltonian_paths(_event_edges(spark, sf_dir), _G)
    return hp.select(*_G, F.concat_ws(">", "path").alias("path"))


@register("graph_degree_euler", f"""
WITH RECURSIVE {_EV_SQL},
deg AS (SELECT user_id, week, u AS node, count(*) AS degree FROM adj GROUP BY ALL),
per AS (
  SELECT user_id, week, count(*) AS n_nodes, CAST(sum(degree) / 2 AS BIGINT) AS n_edges,
         CAST(sum(CASE WHEN degree % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_odd
  FROM deg GROUP BY ALL),
reach(user_id, week, src, dst) AS (
  SELECT user_id, week, node, node FROM nodes
  UNION
  SELECT r.user_id, r.week, r.src, a.v FROM reach r
  JOIN adj a ON a.user_id = r.user_id AND a.week = r.week AND a.u = r.dst),
lab AS (SELECT user_id, week, src, min(dst) AS label FROM reach GROUP BY ALL),
comp AS (SELECT user_id, week, count(DISTINCT label) AS n_comp FROM lab GROUP BY ALL)
SELECT user_id, week, n_nodes, n_edges, n_odd, n_comp = 1 AS connected,
       n_comp = 1 AND n_odd IN (0, 2) AS euler_path, n_comp = 1 AND n_odd = 0 AS euler_cycle
FROM per JOIN comp USING (user_id, week)""")
def graph_degree_euler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.degree_euler(_event_edges(spark, sf_dir), _G)


@register("graph_grid_edges", f"""
WITH {_GRID_SQL}
SELECT graph_id, u, v, kind FROM gedges""")
def graph_grid_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.sight_edges(_grid_nodes(spark, sf_dir), ["graph_id"])


@register("graph_json_round_trip", f"""
WITH {_GRID_SQL}
SELECT e.graph_id, e.u, e.v, a.x AS ux, a.y AS uy, b.x AS vx, b.y AS vy
FROM gedges e JOIN gnodes a ON a.graph_id = e.graph_id AND a.node_id = e.u
              JOIN gnodes b ON b.graph_id = e.graph_id AND b.node_id = e.v""")
def graph_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in parts, far smaller than a graph, read back and joined."""
    nodes = cut_lineage(_grid_nodes(spark, sf_dir))
    msgs = cut_lineage(G.graph_messages(nodes, G.sight_edges(nodes, ["graph_id"]), ["graph_id"], part_size=PART_SIZE))
    return G.joined_coordinates(*G.parse_graph_messages(msgs, ["graph_id"]), ["graph_id"])


@register("graph_cycle_samples", f"""
WITH RECURSIVE {_EV_SQL}, {_CYCLES_SQL},
h AS (SELECT c.user_id, c.week, c.cycle FROM cycles c JOIN sizes s USING (user_id, week) WHERE c.length = s.n_nodes),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, week ORDER BY cycle) - 1 AS pos,
             count(*) OVER (PARTITION BY user_id, week) AS n FROM h)
SELECT user_id, week, cycle, CAST(i.range AS INTEGER) AS pick
FROM r JOIN range(1, 7) i ON (CAST(floor(i.range * r.n / 6) AS BIGINT) - 1 + r.n) % r.n = r.pos""")
def graph_cycle_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    cyc = G.simple_cycles(_event_edges(spark, sf_dir), _G, hamiltonian=True)
    named = cyc.select(*_G, F.concat_ws(">", "cycle").alias("cycle"))
    return G.evenly_spaced(named, _G, "cycle", 6).select(*_G, "cycle", "pick")


@register("graph_cycle_steps", f"""
WITH RECURSIVE {_EV_SQL}, {_CYCLES_SQL},
h AS (SELECT c.user_id, c.week, c.cycle, string_split(c.cycle, '>') AS p
      FROM cycles c JOIN sizes s USING (user_id, week) WHERE c.length = s.n_nodes),
hi AS (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM h)
SELECT user_id, week, cycle, CAST(i - 1 AS INTEGER) AS step, p[i] AS u,
       CASE WHEN i = len(p) THEN p[1] ELSE p[i + 1] END AS v
FROM hi""")
def graph_cycle_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    cyc = G.simple_cycles(_event_edges(spark, sf_dir), _G, hamiltonian=True)
    named = cyc.select(*_G, F.col("cycle").alias("path"), F.concat_ws(">", "cycle").alias("cycle"))
    return G.path_steps(named, "path").select(*_G, "cycle", "step", "u", "v")


@register("graph_axis_edges", """
WITH gnodes AS (
  SELECT c_mktsegment AS graph_id, c_nationkey AS x, CAST(floor(c_acctbal / 1000) AS INTEGER) AS y,
         min(c_custkey) AS node_id
  FROM customer GROUP BY 1, 2, 3),
ge AS (
  SELECT graph_id, node_id AS a, lead(node_id) OVER (PARTITION BY graph_id, y ORDER BY x) AS b FROM gnodes
  UNION ALL SELECT graph_id, node_id, lead(node_id) OVER (PARTITION BY graph_id, x ORDER BY y) FROM gnodes)
SELECT graph_id, least(a, b) AS u, greatest(a, b) AS v, 'axis' AS kind FROM ge WHERE b IS NOT NULL""")
def graph_axis_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns only: the next node in the same row or column."""
    return G.sight_edges(_grid_nodes(spark, sf_dir), ["graph_id"], diagonals=False)
