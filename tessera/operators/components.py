"""Connected components by star contraction.

Alternating large-star and small-star rounds join every node to the least node it can see, so
rounds grow with the logarithm of the longest path, not with its length.  The loop ends when a
round changes nothing; there is no limit on rounds.  Edges stay distributed: each round is a
map-side combined minimum per node and a join with it, both sides read from written tables so
that adaptive execution can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _star(edges: DataFrame, keep: Column, also: bool) -> DataFrame:
    """For every ``u`` link its kept neighbours (and with ``also`` itself) to their least node."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("_m")).select(
        "u", F.least("u", "_m").alias("_m")))
    linked = edges.where(keep).join(least, "u")
    out = linked.select(F.col("v").alias("u"), F.col("_m").alias("v"))
    if also:
        out = out.unionByName(least.select("u", F.col("_m").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the least node of the component of every node that has an edge.

    Nodes are of any orderable type; edges are undirected, may repeat, and rows with a null end
    or both ends alike are ignored."""
    ends = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a != b")
    now = cut_lineage(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut_lineage(_star(both, F.col("v") > F.col("u"), also=False))
        # Large-star edges lead from greater to lesser nodes; small-star keeps that.
        now = cut_lineage(_star(large, F.lit(True), also=True))
        after = _state(now)
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = after


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them: one row to the driver."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit((1 << 31) - 1))).alias("s")).first()
    return row["n"], row["x"], row["s"]
