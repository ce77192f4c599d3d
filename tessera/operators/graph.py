"""Graph jobs over many small undirected graphs at once (``graph_cols`` identify a graph).

* Edge derivation: transitions between consecutive events (range-partitioned, so a hot
  key is spread over many tasks), and line-of-sight neighbours
  on a grid (rows, columns and 45-degree diagonals) with ``lead`` windows.
* Cycle and path enumeration by meeting in the middle: partial paths of up to half the
  length are extended one hop per iteration by an equi-join with the adjacency on
  ``(graph, last node)`` and then joined in pairs; every hop is written as a table in the
  checkpoint folder, so a lost executor recomputes one hop, not the whole chain.
  Canonical forms avoid duplicates without any post-hoc distinct:
  a cycle starts at its smallest node and runs towards the smaller neighbour; a path
  starts at the smaller end.
* Degree and Euler test, with connectivity from min-label propagation.

Enumeration is exponential in the size of one graph by nature; scale comes from many
graphs processed together, which is what the frontier join distributes.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.components import connected_components
from tessera.operators.indexing import dense_index
from tessera.session import cut_lineage


def canonical_edges(edges: DataFrame, graph_cols: Sequence[str], u: str = "u", v: str = "v") -> DataFrame:
    """One row per undirected edge ``(graph, u < v)``; self loops dropped."""
    g = list(graph_cols)
    return (
        edges.where(F.col(u) != F.col(v))
        .select(*g, F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))
        .distinct()
    )


def symmetric(edges: DataFrame, graph_cols: Sequence[str]) -> DataFrame:
    g = list(graph_cols)
    return edges.select(*g, "u", "v").unionByName(edges.select(*g, F.col("v").alias("u"), F.col("u").alias("v")))


def consecutive_pairs(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                      value_col: str) -> DataFrame:
    """Every value and the next one in ``order_cols`` order within its key: ``(*keys, a, b)``.

    Skew-proof ``lead``: rows are range-partitioned on (key, order) -- a key holding a
    third of all rows spans many partitions -- and written once so every row's partition
    is fixed.  ``lead`` runs per (partition, key); the pairs that cross a partition
    boundary come from a table of each (key, partition)'s first and last value, which
    has at most one row per key and partition.
    """
    k = list(key_cols)
    order = list(order_cols)
    base = df.select(*k, *order, F.col(value_col).alias("_v"))
    ordered = cut_lineage(base.repartitionByRange(*k, *order).sortWithinPartitions(*k, *order)
                          .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", *k).orderBy(*order)
    inner = (ordered.select(*k, F.col("_v").alias("a"), F.lead("_v").over(w).alias("b"),
                            F.lead(F.lit(1)).over(w).alias("_has"))
             .where(F.col("_has").isNotNull()).drop("_has"))
    pos = F.struct(*[F.col(c) for c in order])
    ends = ordered.groupBy(*k, "_pid").agg(F.min_by("_v", pos).alias("_first"), F.max_by("_v", pos).alias("_last"))
    wp = Window.partitionBy(*k).orderBy("_pid")
    cross = (ends.select(*k, F.col("_last").alias("a"), F.lead("_first").over(wp).alias("b"),
                         F.lead(F.lit(1)).over(wp).alias("_has"))
             .where(F.col("_has").isNotNull()).drop("_has"))
    return inner.unionByName(cross)


def transitions(events: DataFrame, key_cols: Sequence[str], ts_col: str, tie_col: str,
                value_col: str) -> DataFrame:
    """Consecutive ``(a, b)`` value pairs per key in ``(ts, tie)`` order."""
    return consecutive_pairs(events, key_cols, [ts_col, tie_col], value_col)


def transition_edges(events: DataFrame, key_cols: Sequence[str], ts_col: str, tie_col: str,
                     value_col: str) -> DataFrame:
    """Undirected graph per key: an edge joins two different consecutive values."""
    t = transitions(events, key_cols, ts_col, tie_col, value_col)
    return canonical_edges(t.withColumnRenamed("a", "u").withColumnRenamed("b", "v"), key_cols)


def sight_directions(max_step: int) -> list[tuple[int, int]]:
    """One of each pair of opposite coprime directions with steps of at most ``max_step``."""
    return [(dx, dy) for dx in range(max_step + 1) for dy in range(-max_step, max_step + 1)
            if gcd(dx, dy) == 1 and (dx > 0 or dy > 0)]


def sight_edges(nodes: DataFrame, graph_cols: Sequence[str], diagonals: bool = True, max_step: int = 1,
                node_col: str = "node_id", x: str = "x", y: str = "y") -> DataFrame:
    """Edges to the nearest node along each row and column (``kind='axis'``) and, when
    ``diagonals``, along the lines of every coprime direction with steps of at most ``max_step``
    (``kind='diagonal'``; 1: the 45-degree lines): a node hidden behind another on the same line
    is never joined.  With the extent of the grid as ``max_step`` every visible pair is an edge.

    All line families go through one skew-proof ``consecutive_pairs`` pass keyed by
    (graph, direction, line) and ordered by the position on the line.  Coordinates are whole."""
    g = list(graph_cols)
    lines = None
    for fam, (dx, dy) in enumerate(sight_directions(max_step)):
        kind = "axis" if 0 in (dx, dy) else "diagonal"
        if kind == "diagonal" and not diagonals:
            continue
        line = F.col(x) * dy - F.col(y) * dx
        part = nodes.select(*g, F.lit(kind).alias("_kind"), F.lit(fam).alias("_fam"), line.alias("_line"),
                            F.col(x if dx else y).alias("_pos"), F.col(node_col).alias("_node"))
        lines = part if lines is None else lines.unionByName(part)
    pairs = consecutive_pairs(lines, [*g, "_kind", "_fam", "_line"], ["_pos"], "_node")
    return pairs.select(*g, F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.col("_kind").alias("kind"))


def _nodes(adj: DataFrame, g: list[str]) -> DataFrame:
    return adj.select(*g, F.col("u").alias("node")).distinct()


def _sizes(adj: DataFrame, g: list[str]) -> DataFrame:
    return _nodes(adj, g).groupBy(*g).agg(F.count(F.lit(1)).alias("n_nodes"), F.min("node").alias("min_node"))


def _extend(frontier: DataFrame, adj: DataFrame, g: list[str]) -> DataFrame:
    return frontier.join(adj.withColumnRenamed("u", "last"), [*g, "last"])


def _guard(frontier: DataFrame, max_frontier_rows: int | None) -> None:
    """Fail loudly (never truncate) when a frontier outgrows an explicit bound."""
    if max_frontier_rows is not None and frontier.limit(max_frontier_rows + 1).count() > max_frontier_rows:
        raise RuntimeError(f"path frontier exceeds {max_frontier_rows} rows; raise the bound or "
                           "split the graphs")


def _arms(starts: DataFrame, adj: DataFrame, g: list[str], hops: int, goes_on: Column, max_frontier_rows: int | None) -> list[DataFrame]:
    """Simple paths from the rows of ``starts`` (path of one node, last and further columns) by number
    of edges, from none to ``hops``; every hop is one join and one table.  ``goes_on`` is a condition
    on a path, its further columns and the next node ``v``."""
    arms, frontier = [starts], starts
    for _ in range(hops):
        step = _extend(frontier, adj, g).where(goes_on & ~F.array_contains("path", F.col("v")))
        kept = [c for c in starts.columns if c not in ("last", "path")]
        frontier = cut_lineage(step.select(*kept, F.col("v").alias("last"), F.array_append("path", F.col("v")).alias("path"))
                               .select(starts.columns))
        _guard(frontier, max_frontier_rows)
        if frontier.isEmpty():
            break
        arms.append(frontier)
    return arms


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _interior(path: str) -> Column:
    return F.slice(path, 2, F.greatest(F.size(path) - 2, F.lit(0)))


def _closed(met: DataFrame, g: list[str]) -> DataFrame:
    """Cycles of two arms, ``b`` as long as ``a`` or longer by one edge.  A cycle runs towards the smaller
    neighbour of its start, which ``a`` holds: each cycle has one such pair of arms, and the other
    pairs (in the other order, or split on the other side of the middle) don't count."""
    cycle = F.concat("a", F.reverse(_interior("b")))
    return met.where(F.element_at("a", 2) < F.element_at("b", 2)).select(*g, F.size(cycle).alias("length"), cycle.alias("cycle"))


def simple_cycles(edges: DataFrame, graph_cols: Sequence[str], max_len: int | None = None,
                  hamiltonian: bool = False, max_frontier_rows: int | None = None) -> DataFrame:
    """Every simple cycle (length >= 3) once: ``(graph, length, cycle)``.

    A cycle is two arms that leave its smallest node, meet at one node half way round and share no
    other: arms of up to half of the longest cycle are grown, and one join on (graph, start, meeting
    node) pairs them.  So no path longer than half a cycle is followed, whether it closes or not.

    ``hamiltonian=True`` keeps cycles through all nodes of their graph: arms start at the graph's
    smallest node, an arm only meets one through exactly the nodes that it leaves out, and graphs
    with a node of degree one are left out first.  ``max_len`` limits the cycle length (a parameter
    of the enumeration, not a cap on results); ``max_frontier_rows`` makes an exponential blow-up
    fail instead of filling the cluster.
    """
    g = list(graph_cols)
    adj = cut_lineage(symmetric(canonical_edges(edges, g), g))
    if hamiltonian:
        return _hamiltonian_cycles(adj, g, max_len, max_frontier_rows)
    if max_len is None:
        max_len = _sizes(adj, g).agg(F.max("n_nodes")).first()[0] or 0
    starts = _nodes(adj, g).select(*g, F.col("node").alias("start"), F.col("node").alias("last"), F.array("node").alias("path"))
    arms = _arms(starts, adj, g, (int(max_len) + 1) // 2, F.col("v") > F.col("start"), max_frontier_rows)
    if len(arms) < 3:  # no path of two edges: no cycle
        return starts.select(*g, F.lit(0).alias("length"), F.col("path").alias("cycle")).where(F.lit(False))
    arm = _all(arms[1:])
    a, b = arm.withColumnRenamed("path", "a"), arm.withColumnRenamed("path", "b")
    met = a.join(b, [*g, "start", "last"]).where((F.size("b") - F.size("a")).isin(0, 1) & ~F.arrays_overlap(_interior("a"), _interior("b")))
    return _closed(met, g).where(F.col("length").between(3, int(max_len)))


def _profile(adj: DataFrame, g: list[str]) -> DataFrame:
    """Per graph: its nodes in order, their number, how many have degree one."""
    degree = adj.groupBy(*g, F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    return degree.groupBy(*g).agg(F.sort_array(F.collect_list("node")).alias("nodes"), F.count(F.lit(1)).cast("int").alias("n"),
                                  F.sum((F.col("degree") == 1).cast("int")).alias("ends"))


def _hamiltonian_cycles(adj: DataFrame, g: list[str], max_len: int | None, max_frontier_rows: int | None) -> DataFrame:
    sizes = _profile(adj, g).where("n >= 3 and ends = 0")
    if max_len is not None:
        sizes = sizes.where(F.col("n") <= max_len)
    sizes = cut_lineage(sizes)
    most = sizes.agg(F.max("n")).first()[0] or 0
    half = F.expr("n div 2")
    starts = sizes.select(*g, "n", F.element_at("nodes", 1).alias("last"), F.array(F.element_at("nodes", 1)).alias("path"))
    arms = _all(_arms(starts, adj, g, most - most // 2, F.size("path") <= F.col("n") - half, max_frontier_rows))
    a = arms.where(F.size("path") == half + 1).select(*g, "last", F.col("path").alias("a"), F.sort_array(_interior("path")).alias("rest"))
    b = arms.where(F.size("path") == F.col("n") - half + 1).join(sizes.select(*g, "nodes"), g).select(
        *g, "last", F.col("path").alias("b"), F.array_except("nodes", "path").alias("rest"))
    return _closed(a.join(b, [*g, "last", "rest"]), g)


def hamiltonian_paths(edges: DataFrame, graph_cols: Sequence[str],
                      max_frontier_rows: int | None = None) -> DataFrame:
    """Every path through all nodes of its graph once (reversal counted once):
    ``(graph, path)`` with ``path[0] < path[-1]``; graphs of one node have none.

    A path is two arms that leave its middle node through disjoint halves of the other nodes: arms of
    up to half the length are grown from every node, and an arm is joined to those through exactly the
    nodes that it leaves out.  Graphs with over two nodes of degree one are left out first."""
    g = list(graph_cols)
    adj = cut_lineage(symmetric(canonical_edges(edges, g), g))
    sizes = cut_lineage(_profile(adj, g).where("n >= 2 and ends <= 2"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    half = F.expr("(n - 1) div 2")
    starts = sizes.select(*g, "n", F.explode("nodes").alias("last")).withColumn("path", F.array("last"))
    arms = _all(_arms(starts, adj, g, max(most - 1, 0) - max(most - 1, 0) // 2, F.size("path") <= F.col("n") - 1 - half, max_frontier_rows))
    tail = F.slice("path", 2, F.size("path"))
    a = arms.where(F.size("path") == half + 1).select(*g, F.element_at("path", 1).alias("middle"), F.col("path").alias("a"),
                                                      F.sort_array(tail).alias("rest"))
    b = arms.where(F.size("path") == F.col("n") - half).join(sizes.select(*g, "nodes"), g).select(
        *g, F.element_at("path", 1).alias("middle"), F.col("path").alias("b"), F.array_except("nodes", "path").alias("rest"))
    met = a.join(b, [*g, "middle", "rest"]).where(F.element_at("a", -1) < F.element_at("b", -1))
    return met.select(*g, F.concat(F.reverse("a"), F.slice("b", 2, F.size("b"))).alias("path"))


def components(edges: DataFrame, graph_cols: Sequence[str]) -> DataFrame:
    """Component label (smallest reachable node) per ``(graph, node)``: star contraction over
    nodes keyed by their graph, until nothing changes."""
    g = list(graph_cols)
    ends = canonical_edges(edges, g).select(F.struct(*g, F.col("u").alias("node")).alias("u"),
                                            F.struct(*g, F.col("v").alias("node")).alias("v"))
    return connected_components(ends).select(
        *[F.col(f"node.{c}").alias(c) for c in g], F.col("node.node").alias("node"), F.col("component.node").alias("label"))


def degree_euler(edges: DataFrame, graph_cols: Sequence[str]) -> DataFrame:
    """Per graph: nodes, edges, odd-degree nodes, connectivity and the Euler tests.

    An Euler path exists iff the graph (nodes with edges) is connected and has 0 or 2
    odd-degree nodes; an Euler cycle iff connected and 0 odd-degree nodes.
    """
    g = list(graph_cols)
    canon = cut_lineage(canonical_edges(edges, g))
    deg = symmetric(canon, g).groupBy(*g, F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    per = deg.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        (F.sum("degree") / 2).cast("bigint").alias("n_edges"),
        F.sum((F.col("degree") % 2 == 1).cast("int")).cast("bigint").alias("n_odd"))
    comp = components(canon, g).groupBy(*g).agg(F.countDistinct("label").alias("n_comp"))
    connected: Column = F.col("n_comp") == 1
    return per.join(comp, g).select(
        *g, "n_nodes", "n_edges", "n_odd", connected.alias("connected"),
        (connected & F.col("n_odd").isin(0, 2)).alias("euler_path"),
        (connected & (F.col("n_odd") == 0)).alias("euler_cycle"))


def graph_messages(nodes: DataFrame, edges: DataFrame, graph_cols: Sequence[str],
                   node_col: str = "node_id", part_size: int | None = None) -> DataFrame:
    """JSON messages ``{"nodes_dict": [{node_id,x,y}], "edges_list": [[u,v]]}``: one per graph, or with
    ``part_size`` numbered parts of about that many nodes and edges.

    Output ``(graph, message)``, with parts ``(graph, part, parts, message)``.  Rows go to parts by a
    hash, so no task holds a whole graph and a part's size doesn't grow with the graph."""
    g = list(graph_cols)
    n = nodes.select(*g, F.struct(F.col(node_col).alias("node_id"), "x", "y").alias("n"), F.lit(None).cast("array<bigint>").alias("e"))
    e = edges.select(*g, F.lit(None).cast(n.schema["n"].dataType).alias("n"), F.array("u", "v").cast("array<bigint>").alias("e"))
    rows, by = n.unionByName(e), g
    if part_size is not None:
        if part_size < 1:
            raise ValueError("part_size must be >= 1")
        sizes = rows.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / part_size).cast("int").alias("parts"))
        rows = rows.join(sizes, g).withColumn("part", F.pmod(F.xxhash64("n", "e"), F.col("parts")).cast("int"))
        by = [*g, "part", "parts"]
    body = rows.groupBy(*by).agg(F.sort_array(F.collect_list("n")).alias("nodes_dict"), F.sort_array(F.collect_list("e")).alias("edges_list"))
    return body.select(*by, F.to_json(F.struct("nodes_dict", "edges_list")).alias("message"))


def missing_parts(messages: DataFrame, graph_cols: Sequence[str]) -> DataFrame:
    """Graphs whose numbered messages are not all there, or there twice: ``(graph, parts, found)``.
    A part that no row fell into has no message, so only numbers out of range or repeated count."""
    g = list(graph_cols)
    per = messages.groupBy(*g).agg(F.max("parts").alias("parts"), F.min("parts").alias("least"), F.count(F.lit(1)).alias("found"),
                                   F.count_distinct("part").alias("distinct"), F.max("part").alias("last"))
    return per.where((F.col("found") != F.col("distinct")) | (F.col("last") >= F.col("parts")) | (F.col("least") != F.col("parts"))).select(
        *g, "parts", "found")


GRAPH_MESSAGE_SCHEMA = ("struct<nodes_dict: array<struct<node_id: bigint, x: int, y: int>>, "
                        "edges_list: array<array<bigint>>>")


def parse_graph_messages(messages: DataFrame, graph_cols: Sequence[str], msg_col: str = "message"
                         ) -> tuple[DataFrame, DataFrame]:
    """Nested JSON message -> node table and edge table (``inline`` / ``explode``)."""
    g = list(graph_cols)
    parsed = messages.select(*g, F.from_json(msg_col, GRAPH_MESSAGE_SCHEMA).alias("m"))
    nodes = parsed.select(*g, F.inline("m.nodes_dict"))  # of all parts, if a graph has several
    edges = parsed.select(*g, F.explode("m.edges_list").alias("e")) \
        .select(*g, F.element_at("e", 1).alias("u"), F.element_at("e", 2).alias("v"))
    return nodes, edges


def evenly_spaced(paths: DataFrame, graph_cols: Sequence[str], order_col: str, picks: int = 6) -> DataFrame:
    """Pick ``picks`` items per graph at positions ``i * n // picks - 1`` (1-based ``i``)
    of the ``order_col`` order, a negative position counting from the end as list
    indexing does: ``(graph, pick, ...)``.

    Positions come from one global dense index over (graph, order) -- range-partitioned,
    so a graph with most of the items is spread over many tasks -- minus each graph's
    first index (one aggregate row per graph)."""
    g = list(graph_cols)
    idx = dense_index(paths, [*g, order_col], "_gpos")
    first = idx.groupBy(*g).agg(F.min("_gpos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    ranked = idx.join(first, g).withColumn("_pos", F.col("_gpos") - F.col("_start"))
    want = F.sequence(F.lit(1), F.lit(picks))
    hit = F.filter(want, lambda i: F.pmod(F.floor(i * F.col("_n") / picks) - 1, F.col("_n")) == F.col("_pos"))
    return ranked.select("*", F.explode(hit).alias("pick")).drop("_gpos", "_start", "_pos", "_n")


def path_steps(paths: DataFrame, path_col: str, closed: bool = True) -> DataFrame:
    """Consecutive node pairs of each path ``(..., step, u, v)``; ``closed`` adds the edge
    back to the first node (a cycle)."""
    nxt = F.slice(path_col, 2, F.size(path_col))
    if closed:
        nxt = F.concat(nxt, F.array(F.element_at(path_col, 1)))
    pairs = F.arrays_zip(F.col(path_col).alias("u"), nxt.alias("v"))
    if not closed:
        pairs = F.slice(pairs, 1, F.size(path_col) - 1)
    return paths.select("*", F.posexplode(pairs).alias("step", "_p")) \
        .select(*[c for c in paths.columns], "step", F.col("_p.u").alias("u"), F.col("_p.v").alias("v"))


def edge_coordinates(messages: DataFrame, graph_cols: Sequence[str], msg_col: str = "message") -> DataFrame:
    """Edges of each parsed message with both end points' coordinates, looked up in a map
    built from the same message's node list (in-row, no join):
    ``(graph, u, v, ux, uy, vx, vy)``."""
    g = list(graph_cols)
    parsed = messages.select(*g, F.from_json(msg_col, GRAPH_MESSAGE_SCHEMA).alias("m"))
    pos = F.map_from_entries(F.transform("m.nodes_dict", lambda n: F.struct(
        n["node_id"], F.struct(n["x"].alias("x"), n["y"].alias("y")))))
    return (
        parsed.select(*g, pos.alias("_pos"), F.explode("m.edges_list").alias("e"))
        .select(*g, F.element_at("e", 1).alias("u"), F.element_at("e", 2).alias("v"), "_pos")
        .select(*g, "u", "v",
                F.element_at("_pos", F.col("u"))["x"].alias("ux"), F.element_at("_pos", F.col("u"))["y"].alias("uy"),
                F.element_at("_pos", F.col("v"))["x"].alias("vx"), F.element_at("_pos", F.col("v"))["y"].alias("vy"))
    )


def joined_coordinates(nodes: DataFrame, edges: DataFrame, graph_cols: Sequence[str]) -> DataFrame:
    """Edges with both end points' coordinates by joins on the node, for graphs that came in parts:
    ``(graph, u, v, ux, uy, vx, vy)``."""
    g = list(graph_cols)
    ends = [nodes.select(*g, F.col("node_id").alias(c), F.col("x").alias(f"{c}x"), F.col("y").alias(f"{c}y")) for c in ("u", "v")]
    return edges.join(ends[0], [*g, "u"]).join(ends[1], [*g, "v"]).select(*g, "u", "v", "ux", "uy", "vx", "vy")
