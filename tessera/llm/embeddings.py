"""Embedding near-dedup by a random-projection tree forest.

* Equal vectors of a label are one class, found by a grouped hash; a class is compared once.
* The forest is fitted on a bounded sample: a node splits its sample along a random direction,
  at the place near the median that leaves the fewest sample points within the overlap, and
  stops at ``LEAF`` points or where half of the points would go both ways.
* Every class is sent down every tree.  Points within the overlap of a split go both ways (spill),
  so a close pair parts only if its difference along a random direction exceeds twice the overlap.
* Within a leaf all vectors are compared by cosine in double precision, in blocks: a large leaf
  is cut into blocks by hash, and each pair of blocks is a task's work of bounded size, so no
  leaf is capped and none is compared by one task alone.
* Links of all leaves are united (each counted once); components come from star contraction.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, spread_scan, write_table
from tessera.operators.components import connected_components
from tessera.session import ship_package

THRESHOLD = 0.98
TREES = 4
#: Classes that the forest is fitted on, about (all if there are fewer).
SAMPLE = 20_000
#: Sample points of a node that is not split further.
LEAF = 64
#: Overlap of a split in standard deviations of a just-linked pair's difference along it.
OVERLAP = 1.2
#: Vectors of one block of a leaf.
BLOCK = 256


class Tree:
    """A random-projection tree over unit vectors, as arrays of nodes."""

    def __init__(self, points: np.ndarray, overlap: float, seed: int):
        rng = np.random.default_rng(seed)
        self.overlap = overlap
        self.directions: list[np.ndarray | None] = []
        self.cuts: list[float] = []
        self.sides: list[tuple[int, int]] = []
        self._grow(points, np.arange(len(points)), rng)

    def _grow(self, points: np.ndarray, rows: np.ndarray, rng) -> int:
        at = len(self.cuts)
        self.directions.append(None)
        self.cuts.append(0.0)
        self.sides.append((-1, -1))
        if len(rows) <= LEAF:
            return at
        direction = rng.standard_normal(points.shape[1])
        direction /= np.linalg.norm(direction)
        along = np.sort(points[rows] @ direction)
        places = np.quantile(along, np.linspace(0.25, 0.75, 41))
        both = np.searchsorted(along, places + self.overlap, "right") - np.searchsorted(along, places - self.overlap, "left")
        best = int(np.argmin(both + 1e-6 * np.abs(np.arange(41) - 20)))
        if both[best] > 0.5 * len(rows):
            return at
        cut = float(places[best])
        self.directions[at], self.cuts[at] = direction, cut
        along = points[rows] @ direction
        left = self._grow(points, rows[along <= cut + self.overlap], rng) if (along <= cut + self.overlap).sum() < len(rows) else -1
        right = self._grow(points, rows[along >= cut - self.overlap], rng) if (along >= cut - self.overlap).sum() < len(rows) else -1
        if left < 0 or right < 0:
            self.directions[at] = None
        else:
            self.sides[at] = (left, right)
        return at

    def leaves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that a point reaches."""
        rows_out, leaves_out = [], []
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            direction = self.directions[node]
            if direction is None:
                rows_out.append(rows)
                leaves_out.append(np.full(len(rows), node))
                continue
            along = points[rows] @ direction
            left, right = self.sides[node]
            todo.append((left, rows[along <= self.cuts[node] + self.overlap]))
            todo.append((right, rows[along >= self.cuts[node] - self.overlap]))
        return (np.concatenate(rows_out), np.concatenate(leaves_out)) if rows_out else (np.empty(0, int), np.empty(0, int))


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_forest(sample: pd.DataFrame, threshold: float) -> dict:
    """{(label, dimension): trees} of sampled (label, embedding)."""
    forest: dict[tuple, list[Tree]] = {}
    if not len(sample):
        return forest
    sample = sample.assign(d=sample["embedding"].map(len))
    for (label, d), part in sample.groupby(["label", "d"], sort=True):
        points = unit(np.stack(part["embedding"].to_numpy()))
        apart = math.sqrt(max(0.0, 2 - 2 * threshold) / d)
        seeds = [zlib.crc32(f"{label}/{d}/{t}".encode()) for t in range(TREES)]
        forest[str(label), int(d)] = [Tree(points, OVERLAP * apart, s) for s in seeds]
    return forest


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the key of their class, classes).  A row belongs to a class if its id and label
    are not null and its vector is neither null nor empty nor zero, without null or non-finite parts."""
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("k1", F.when(F.col("sound"), F.xxhash64("label", "embedding"))).withColumn(
        "k2", F.when(F.col("sound"), F.xxhash64(F.lit(1), "embedding", "label")))
    classes = write_table(rows.where("sound").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")))
    return rows.select("vec_id", "k1", "k2"), classes


def links(classes: DataFrame, threshold: float = THRESHOLD, sample_size: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """Distinct (a, b), a < b: representatives of classes with a cosine of at least ``threshold``."""
    spark = classes.sparkSession
    ship_package(spark)
    n = classes.count()
    chosen = F.xxhash64(F.lit(31), "k1", "k2").bitwiseAND(F.lit((1 << 31) - 1)) / F.lit(float(1 << 31))
    sample = (classes.where(chosen < min(1.0, sample_size / max(n, 1))).select("k1", "k2", "label", "embedding")
              .toPandas().sort_values(["k1", "k2"]))
    forest = spark.sparkContext.broadcast(fit_forest(sample, threshold))

    def index(batches):
        for batch in batches:
            frame = batch.to_pandas()
            d = frame["embedding"].map(len)
            for (label, width), part in frame.groupby([frame["label"], d], sort=False):
                points = unit(np.stack(part["embedding"].to_numpy()))
                trees = forest.value.get((str(label), int(width)), [None])
                for t, tree in enumerate(trees):
                    rows, leaf = tree.leaves(points) if tree else (np.arange(len(part)), np.zeros(len(part), int))
                    for at in range(0, len(rows), 4096):
                        r = rows[at:at + 4096]
                        m = len(r)
                        yield pa.RecordBatch.from_pydict({
                            "leaf": pa.array([f"{label}/{width}/{t}/{k}" for k in leaf[at:at + 4096].tolist()]),
                            "rep": pa.array(part["rep"].to_numpy()[r]).cast(batch.schema.field("rep").type),
                            "embedding": pa.array([part["embedding"].to_numpy()[k] for k in r], pa.list_(pa.float64())),
                            "spot": pa.array(part["spot"].to_numpy()[r], pa.int64())} if m else {})

    rep = classes.schema["rep"].dataType.simpleString()
    spread = classes.select("label", "rep", "embedding", F.xxhash64("k1", "k2").alias("spot"))
    leaves = write_table(arrow_pass(spread_scan(spread), f"leaf string, rep {rep}, embedding array<double>, spot bigint", index))
    sizes = write_table(leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("leaf", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    placed = leaves.join(sizes, "leaf").withColumn("own", F.pmod("spot", F.col("blocks")).cast("int"))
    # Each vector meets every block of its leaf, its own included: one group for each pair of blocks.
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "leaf", "rep", "embedding", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        ids, v = group["rep"].to_numpy(), unit(np.stack(group["embedding"].to_numpy()))
        left = np.flatnonzero(group["own"].to_numpy() == i)
        right = left if i == j else np.flatnonzero(group["own"].to_numpy() == j)
        found_a, found_b = [], []
        for at in range(0, len(left), block):
            rows = left[at:at + block]
            a, b = np.nonzero(v[rows] @ v[right].T >= threshold)
            found_a.append(ids[rows[a]])
            found_b.append(ids[right[b]])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        keep = a != b
        return pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]}).drop_duplicates()

    return paired.groupBy("leaf", "i", "j").applyInPandas(compare, f"a {rep}, b {rep}").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (least
    vec_id reachable by links), kept (vec_id = component_id).

    Only vectors of equal labels are compared.  Vectors that are null, empty, zero or hold null or
    non-finite parts, and rows with a null id or label, link with nothing (component_id is their
    own id; a null id has kept false).  Equal rows are linked; rows of one id are one node of the
    components.  Other columns are ignored; an empty table gives no rows."""
    rows, classes = vector_classes(vectors, id_col, vector_col, label_col)
    pairs = write_table(links(classes, threshold))
    size = classes.groupBy("rep").agg(F.sum("size").alias("size"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (both.join(size, both["b"] == size["rep"]).groupBy("a").agg(F.sum("size").alias("linked")))
    parts = connected_components(pairs, "a", "b")
    # Written, so that the join with the rows is of two plain shuffles and a hot class can be split.
    result = write_table(
        classes.select("k1", "k2", "rep", "size")
        .join(others, classes["rep"] == others["a"], "left").join(parts, F.col("rep") == parts["node"], "left")
        .select("k1", "k2", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")))
    joined = rows.join(result, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """DuckDB statement for the result over ``embeddings`` with distinct ids: every pair of a label
    compared, components by reachability."""
    return f"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= {threshold}),
reach as (select a, b from p union select r.a, p.b from reach r join p on r.b = p.a),
n as (select a, count(*) as n from p group by a),
c as (select a, least(a, min(b)) as c from reach group by a)
select vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(c.c, vec_id) as component_id, vec_id = coalesce(c.c, vec_id) as kept
from embeddings left join n on n.a = vec_id left join c on c.a = vec_id"""
