import itertools
import json
import random

from pyspark.sql import functions as F

from fixtures import AXIS_EDGES, DIAGONAL_EDGES, NODES
from tessera.operators import graph as G


def _edges(spark, graphs):
    rows = [(g, u, v) for g, es in graphs.items() for u, v in es]
    return spark.createDataFrame(rows, "g STRING, u BIGINT, v BIGINT")


def _brute_cycles(edges):
    adj = {}
    for u, v in edges:
        adj.setdefault(u, set()).add(v)
        adj.setdefault(v, set()).add(u)
    nodes = sorted(adj)
    found = set()
    for k in range(3, len(nodes) + 1):
        for combo in itertools.combinations(nodes, k):
            first = combo[0]
            for perm in itertools.permutations(combo[1:]):
                cyc = (first,) + perm
                if perm[0] < perm[-1] and all(cyc[(i + 1) % k] in adj[cyc[i]] for i in range(k)):
                    found.add(cyc)
    return found


def test_cycles_match_brute_force(spark):
    rng = random.Random(3)
    graphs = {}
    for g in range(8):
        n = rng.randint(3, 6)
        pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
        graphs[f"g{g}"] = rng.sample(pairs, rng.randint(2, len(pairs)))
    got = G.simple_cycles(_edges(spark, graphs), ["g"]).collect()
    ham = G.simple_cycles(_edges(spark, graphs), ["g"], hamiltonian=True).collect()
    for g, es in graphs.items():
        mine = [tuple(r["cycle"]) for r in got if r["g"] == g]
        assert len(mine) == len(set(mine)) and set(mine) == _brute_cycles(es)
        whole = [c for c in _brute_cycles(es) if len(c) == len({v for e in es for v in e})]
        assert sorted(tuple(r["cycle"]) for r in ham if r["g"] == g) == sorted(whole)


def test_grid_fixture_counts(spark):
    axis = _edges(spark, {"axis": AXIS_EDGES})
    both = _edges(spark, {"both": AXIS_EDGES + DIAGONAL_EDGES})
    assert G.simple_cycles(axis, ["g"], hamiltonian=True).count() == 0
    assert G.simple_cycles(both, ["g"], hamiltonian=True).count() == 4136
    by_len = {r["length"]: r["count"] for r in G.simple_cycles(axis, ["g"]).groupBy("length").count().collect()}
    assert by_len == {4: 6, 6: 7, 8: 12, 10: 13, 12: 2}
    assert G.hamiltonian_paths(axis, ["g"]).count() == 0
    eu = {r["g"]: r for r in G.degree_euler(axis.unionByName(both), ["g"]).collect()}
    assert eu["both"]["n_odd"] == 2 and eu["both"]["euler_path"] and not eu["both"]["euler_cycle"]
    assert eu["axis"]["n_odd"] == 10 and not eu["axis"]["euler_path"]
    assert eu["axis"]["connected"] and eu["axis"]["n_edges"] == 19


def test_hamiltonian_paths_fixture(spark):
    both = _edges(spark, {"both": AXIS_EDGES + DIAGONAL_EDGES})
    assert G.hamiltonian_paths(both, ["g"]).count() == 154670


def test_sight_edges_on_fixture(spark):
    nodes = spark.createDataFrame([("grid", k, x, y) for k, (x, y) in NODES.items()],
                                  "g STRING, node_id BIGINT, x INT, y INT")
    got = G.sight_edges(nodes, ["g"]).collect()
    axis = {(r["u"], r["v"]) for r in got if r["kind"] == "axis"}
    diag = {(r["u"], r["v"]) for r in got if r["kind"] == "diagonal"}
    assert axis == set(AXIS_EDGES)
    unit = {(u, v) for u, v in DIAGONAL_EDGES
            if abs(NODES[u][0] - NODES[v][0]) == 1 and abs(NODES[u][1] - NODES[v][1]) == 1}
    assert unit <= diag
    for u, v in diag:
        (x1, y1), (x2, y2) = NODES[u], NODES[v]
        assert abs(x1 - x2) == abs(y1 - y2)
        between = [k for k, (x, y) in NODES.items() if min(x1, x2) < x < max(x1, x2)
                   and abs(x - x1) == abs(y - y1) and (x - x1) * (y2 - y1) == (y - y1) * (x2 - x1)]
        assert not between


def test_graph_message_round_trip(spark):
    nodes = spark.createDataFrame([("grid", k, x, y) for k, (x, y) in NODES.items()],
                                  "graph_id STRING, node_id BIGINT, x INT, y INT")
    edges = spark.createDataFrame([("grid", u, v) for u, v in AXIS_EDGES], "graph_id STRING, u BIGINT, v BIGINT")
    msg = G.graph_messages(nodes, edges, ["graph_id"])
    body = json.loads(msg.first()["message"])
    assert len(body["nodes_dict"]) == 14 and len(body["edges_list"]) == 19
    pn, pe = G.parse_graph_messages(msg, ["graph_id"])
    assert {(r["u"], r["v"]) for r in pe.collect()} == set(AXIS_EDGES)
    assert pn.count() == 14


def test_messages_in_parts(spark):
    nodes = spark.createDataFrame([(g, k, x, y) for g in ("a", "b") for k, (x, y) in NODES.items()],
                                  "graph_id STRING, node_id BIGINT, x INT, y INT")
    edges = spark.createDataFrame([("a", u, v) for u, v in AXIS_EDGES] + [("b", 1, 2)], "graph_id STRING, u BIGINT, v BIGINT")
    msg = G.graph_messages(nodes, edges, ["graph_id"], part_size=5)
    rows = msg.collect()
    sizes = [len(b["nodes_dict"]) + len(b["edges_list"]) for b in (json.loads(r["message"]) for r in rows)]
    assert {r["graph_id"]: r["parts"] for r in rows} == {"a": 7, "b": 3} and max(sizes) < 14 and sum(sizes) == 28 + len(AXIS_EDGES) + 1
    pn, pe = G.parse_graph_messages(msg, ["graph_id"])
    assert pn.count() == 28 and {(r["u"], r["v"]) for r in pe.where("graph_id = 'a'").collect()} == set(AXIS_EDGES)
    got = {(r["graph_id"], r["u"], r["v"]): (r["ux"], r["uy"], r["vx"], r["vy"]) for r in G.joined_coordinates(pn, pe, ["graph_id"]).collect()}
    assert got == {(g, u, v): (*NODES[u], *NODES[v]) for g, es in (("a", AXIS_EDGES), ("b", [(1, 2)])) for u, v in es}
    assert G.missing_parts(msg, ["graph_id"]).count() == 0
    assert [r["graph_id"] for r in G.missing_parts(msg.unionByName(msg.where("graph_id = 'b'")), ["graph_id"]).collect()] == ["b"]
    alone = spark.createDataFrame([("c", 1, 0, 0)], nodes.schema)
    assert G.graph_messages(alone, edges.limit(0), ["graph_id"], part_size=5).count() == 1


def test_transitions_cross_buckets(spark):
    rows = [(1, "2024-01-01 00:10:00", 1, "a"), (1, "2024-01-01 00:50:00", 2, "b"),
            (1, "2024-01-01 03:00:00", 3, "c"), (1, "2024-01-01 03:00:00", 4, "c"),
            (2, "2024-01-01 05:00:00", 5, "a")]
    ev = spark.createDataFrame(rows, "user BIGINT, ts STRING, id BIGINT, t STRING") \
        .withColumn("ts", F.to_timestamp("ts"))
    pairs = sorted((r["user"], r["a"], r["b"]) for r in G.transitions(ev, ["user"], "ts", "id", "t").collect())
    assert pairs == [(1, "a", "b"), (1, "b", "c"), (1, "c", "c")]
    edges = sorted((r["u"], r["v"]) for r in G.transition_edges(ev, ["user"], "ts", "id", "t").collect())
    assert edges == [("a", "b"), ("b", "c")]


def test_edge_coordinates_in_row(spark):
    nodes = spark.createDataFrame([("grid", k, x, y) for k, (x, y) in NODES.items()],
                                  "graph_id STRING, node_id BIGINT, x INT, y INT")
    edges = spark.createDataFrame([("grid", u, v) for u, v in AXIS_EDGES], "graph_id STRING, u BIGINT, v BIGINT")
    got = G.edge_coordinates(G.graph_messages(nodes, edges, ["graph_id"]), ["graph_id"]).collect()
    assert len(got) == 19
    for r in got:
        assert (r["ux"], r["uy"]) == NODES[r["u"]] and (r["vx"], r["vy"]) == NODES[r["v"]]


def test_components_and_euler_on_split_graphs(spark):
    graphs = {"two": [(1, 2), (2, 3), (3, 1), (7, 8)], "path": [(1, 2), (2, 3), (3, 4), (4, 5)],
              "ring": [(1, 2), (2, 3), (3, 4), (4, 1)]}
    lab = {(r["g"], r["node"]): r["label"] for r in G.components(_edges(spark, graphs), ["g"]).collect()}
    assert lab[("two", 3)] == 1 and lab[("two", 8)] == 7 and lab[("path", 5)] == 1
    eu = {r["g"]: r for r in G.degree_euler(_edges(spark, graphs), ["g"]).collect()}
    assert not eu["two"]["connected"] and not eu["two"]["euler_path"]
    assert eu["path"]["euler_path"] and not eu["path"]["euler_cycle"]
    assert eu["ring"]["euler_cycle"] and eu["ring"]["n_odd"] == 0


def test_frontier_guard_fails_loudly(spark):
    import pytest
    both = _edges(spark, {"both": AXIS_EDGES + DIAGONAL_EDGES})
    with pytest.raises(RuntimeError):
        G.simple_cycles(both, ["g"], max_frontier_rows=100)
    assert G.simple_cycles(_edges(spark, {"axis": AXIS_EDGES}), ["g"], max_frontier_rows=10_000).count() == 40


def test_evenly_spaced_matches_list_indexing(spark):
    items = {"g1": ["a", "b", "c", "d"], "g2": [f"x{i:02d}" for i in range(13)]}
    df = spark.createDataFrame([(g, v) for g, vs in items.items() for v in vs], "g STRING, v STRING")
    got = sorted((r["g"], r["pick"], r["v"]) for r in G.evenly_spaced(df, ["g"], "v", 6).collect())
    exp = sorted((g, i, sorted(vs)[i * len(vs) // 6 - 1]) for g, vs in items.items() for i in range(1, 7))
    assert got == exp


def test_transitions_hot_key_across_partitions(spark):
    import random
    rng = random.Random(5)
    rows = [(1, i, rng.choice("abcd")) for i in range(4000)] + [(u, i, rng.choice("abcd")) for u in (2, 3) for i in range(50)]
    ev = spark.createDataFrame(rows, "user BIGINT, t BIGINT, v STRING").withColumn("ts", F.timestamp_seconds("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r["user"], r["a"], r["b"]) for r in G.transitions(ev, ["user"], "ts", "t", "v").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    exp = []
    for u in (1, 2, 3):
        seq = [v for uu, _, v in sorted(r for r in rows if r[0] == u)]
        exp += [(u, a, b) for a, b in zip(seq, seq[1:])]
    assert got == sorted(exp)


def test_sight_lines_in_every_direction(spark):
    from fixtures import AXIS_EDGES, DIAGONAL_EDGES, NODES
    nodes = spark.createDataFrame([(0, k, x, y) for k, (x, y) in NODES.items()], "g INT, node_id INT, x INT, y INT")
    rows = G.sight_edges(nodes, ["g"], max_step=4).collect()
    axis = {(r["u"], r["v"]) for r in rows if r["kind"] == "axis"}
    diagonal = {(r["u"], r["v"]) for r in rows if r["kind"] == "diagonal"}
    assert axis == {tuple(sorted(e)) for e in AXIS_EDGES}
    assert {tuple(sorted(e)) for e in DIAGONAL_EDGES} <= diagonal and len(diagonal) == 46
    near = {(r["u"], r["v"]) for r in G.sight_edges(nodes, ["g"]).collect() if r["kind"] == "diagonal"}
    assert len(near) == 14 and near < diagonal
