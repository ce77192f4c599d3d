"""Neighbours of many query vectors by an inverted index of cells: approximate and exact.

Index.  Pivots are the vectors whose keys have the least md5 (``cells`` of them, so their table has
one size at every scale).  Every vector is keyed by the cell of its nearest pivot, and carries its
angle to that pivot and a sketch: the signs of ``bits`` sums of its components under signs drawn by
md5.  A cell is cut into blocks of about ``BLOCK`` rows, so a hot cell spans many tasks; a block
knows the least and the largest angle to the pivot.  The index is written once and serves any
number of query tables; a zero vector, null, or one that holds anything not finite is in no cell.

Search.  Queries are a table.  Each is joined to the blocks of its ``probes`` nearest cells, and a
task compares one block with up to ``BLOCK`` queries by matrix products, keeping ``k`` rows a query.

* ``approximate``: within the probed cells only rows whose sketch differs from the query's in at
  most ``radius`` bits are compared.  The result says how many rows were sketched and compared.
* ``exact``: the nearest cell gives a bound (the k-th best found there); then every block is read
  whose vectors could be nearer by the triangle inequality for angles.

Scores are cosines rounded to ``SCORE_DECIMALS``; ties are broken by the keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.session import cut_lineage, ship_package

SCORE_DECIMALS = 9
CELLS, BITS = 16, 512
#: Rows of a block, about, and queries that one task compares with a block.
BLOCK = 4096
#: Queries of one matrix product, and vectors that a pass handles at once.
TOGETHER = 256
#: Angles closer than this are not told apart by the bound.
SLACK = 1e-6


@dataclass
class CellIndex:
    """``rows``: keys, cell, block, unit, sketch; ``blocks``: cell, block, n, low, high (angles)."""

    rows: DataFrame
    blocks: DataFrame
    keys: list[str]
    pivots: np.ndarray
    signs: np.ndarray


def units(vectors: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are vectors of the commonest length, finite and not zero; these as unit rows)."""
    arrays = [np.asarray([np.nan if x is None else x for x in v] if v is not None else [], dtype=np.float64) for v in vectors]
    sizes = [len(a) for a in arrays if len(a)]
    width = max(set(sizes), key=sizes.count) if sizes else 0
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.array([np.sqrt(a @ a) if len(a) == width and width else np.nan for a in arrays])
    good = np.flatnonzero(np.isfinite(norms) & (norms > 0))
    return good, (np.stack([arrays[i] for i in good]) / norms[good, None] if len(good) else np.zeros((0, width)))


def drawn_signs(bits: int, width: int) -> np.ndarray:
    """+1 and -1 by the first hexadecimal digit of md5("bit:component")."""
    return np.array([[1.0 if hashlib.md5(f"{b}:{i}".encode()).hexdigest()[0] < "8" else -1.0 for i in range(width)] for b in range(bits)])


def sketches(unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """One row of 64-bit words a vector."""
    if not len(signs):
        return np.zeros((len(unit), 0), np.uint64)
    return np.packbits(unit @ signs.T >= 0, axis=1, bitorder="little").view("<u8")


def nearest(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rounded cosines to the pivots."""
    return np.round(unit @ pivots.T, SCORE_DECIMALS)


def _slices(batches):
    """Few rows at a time: what is made of a row is many times as long."""
    return (pdf.iloc[at:at + TOGETHER] for pdf in batches for at in range(0, len(pdf), TOGETHER))


def build(corpus: DataFrame, keys: Sequence[str], vec_col: str, cells: int = CELLS, bits: int = BITS) -> CellIndex:
    if cells < 1 or bits < 0 or bits % 64:
        raise ValueError("at least one cell, and bits in words of 64")
    keys = list(keys)
    spark = corpus.sparkSession
    ship_package(spark)
    rows = corpus.select(*keys, F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    order = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in keys]))
    chosen = rows.where(finite).orderBy(order, *keys).limit(cells).collect()  # bounded by a parameter
    _, pivots = units([r["vec"] for r in chosen])
    signs = drawn_signs(bits, pivots.shape[1])
    width = pivots.shape[1]
    shared = spark.sparkContext.broadcast((pivots, signs))
    schema = T.StructType([*(corpus.schema[c] for c in keys), T.StructField("cell", T.IntegerType()),
                           T.StructField("angle", T.DoubleType()), T.StructField("unit", T.ArrayType(T.DoubleType())),
                           T.StructField("sketch", T.ArrayType(T.LongType()))])

    def assign(batches):
        pivots, signs = shared.value
        for pdf in _slices(batches):
            good, unit = units(pdf["vec"])
            if not len(good) or unit.shape[1] != width:
                continue
            near = nearest(unit, pivots)
            out = pdf.iloc[good][keys].copy()
            out["cell"] = near.argmax(axis=1).astype(np.int32)
            out["angle"] = np.arccos(np.clip(near.max(axis=1), -1, 1))
            out["unit"] = list(unit)
            out["sketch"] = list(sketches(unit, signs).view(np.int64))
            yield out

    placed = rows.where(finite).mapInPandas(assign, schema).withColumn("at", F.monotonically_increasing_id())
    written = cut_lineage(placed)
    sizes = {r["cell"]: r["n"] for r in written.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a cell
    parts = F.lit(1)
    for cell, n in sizes.items():
        if n > BLOCK:
            parts = F.when(F.col("cell") == cell, F.lit(-(-n // BLOCK))).otherwise(parts)
    blocked = written.withColumn("block", F.pmod(F.xxhash64("at"), parts).cast("int"))
    blocks = blocked.groupBy("cell", "block").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    return CellIndex(blocked.drop("at", "angle"), cut_lineage(blocks), keys, pivots, signs)


def _probed(queries: DataFrame, qid_col: str, qvec_col: str, index: CellIndex, probes: int) -> DataFrame:
    """(qid, cell, place, angle, unit, sketch) for the ``probes`` nearest cells of every query."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.pivots, index.signs))
    width = index.pivots.shape[1]
    schema = T.StructType([T.StructField("qid", queries.schema[qid_col].dataType), T.StructField("cell", T.IntegerType()),
                           T.StructField("place", T.IntegerType()), T.StructField("angle", T.DoubleType()),
                           T.StructField("unit", T.ArrayType(T.DoubleType())), T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches):
        pivots, signs = shared.value
        for pdf in _slices(batches):
            good, unit = units(pdf["vec"])
            if not len(good) or unit.shape[1] != width:
                continue
            near = nearest(unit, pivots)
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            n, p = order.shape
            row = np.repeat(np.arange(n), p)
            sketch = sketches(unit, signs).view(np.int64)
            yield pd.DataFrame({"qid": pdf["qid"].to_numpy()[good][row], "cell": order.ravel().astype(np.int32),
                                "place": np.tile(np.arange(p, dtype=np.int32), n),
                                "angle": np.arccos(np.clip(np.take_along_axis(near, order, 1).ravel(), -1, 1)),
                                "unit": list(unit[row]), "sketch": list(sketch[row])})

    src = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("vec"))
    return src.mapInPandas(run, schema)


def _compare(index: CellIndex, wanted: DataFrame, qid_type: T.DataType, k: int, radius: int | None) -> DataFrame:
    """Best ``k`` rows of every (query, block) in ``wanted``: qid, keys, score, and one row without
    keys that counts: sketched, compared."""
    keys = index.keys
    # Queries of a block in groups of about BLOCK: the block's rows are copied once a group.
    counts = wanted.groupBy("cell", "block").agg(F.count(F.lit(1)).alias("queries"))
    grouped = wanted.join(counts, ["cell", "block"]).withColumn(
        "part", F.pmod(F.xxhash64("qid"), F.ceil(F.col("queries") / BLOCK)).cast("int"))
    grouped = grouped.select("qid", "cell", "block", "part", "unit", "sketch")
    by = ["cell", "block", "part"]
    rows = index.rows.join(grouped.select(by).distinct(), ["cell", "block"])
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # columns of its own, apart from the queries'
    schema = T.StructType([T.StructField("qid", qid_type), *(index.rows.schema[c] for c in keys), T.StructField("score", T.DoubleType()),
                           T.StructField("sketched", T.LongType()), T.StructField("compared", T.LongType())])
    columns = [f.name for f in schema]

    def run(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asked):
            return pd.DataFrame({c: [] for c in columns})
        block = block.sort_values(keys, kind="stable").reset_index(drop=True)
        v = np.stack(block["unit"].to_numpy())
        marks = np.stack(block["sketch"].to_numpy()).view(np.uint64) if radius is not None else None
        qids, units_of, sketched = asked["qid"].to_numpy(), np.stack(asked["unit"].to_numpy()), asked["sketch"].to_numpy()
        places, scores, compared = [], [], np.full(len(qids), len(v))
        for a in range(0, len(qids), TOGETHER):
            near = np.round(v @ units_of[a:a + TOGETHER].T, SCORE_DECIMALS)
            for j in range(near.shape[1]):
                if marks is None:
                    at, score = None, near[:, j]
                else:
                    sketch = np.asarray(sketched[a + j], np.int64).view(np.uint64)
                    at = np.flatnonzero(np.bitwise_count(marks ^ sketch).sum(axis=1, dtype=np.int64) <= radius)
                    score, compared[a + j] = near[at, j], len(at)
                best = np.argsort(-score, kind="stable")[:k]  # rows stand in order of their keys
                places.append(best if at is None else at[best])
                scores.append(score[best])
        found = block.iloc[np.concatenate(places)][keys].reset_index(drop=True)
        found.insert(0, "qid", np.repeat(qids, [len(p) for p in places]))
        found["score"], found["sketched"], found["compared"] = np.concatenate(scores), 0, 0
        counting = pd.DataFrame({"qid": qids, **{c: pd.Series([None] * len(qids), dtype=object) for c in keys}, "score": np.nan,
                                 "sketched": len(v), "compared": compared})
        for c in keys:  # counting rows have no keys, and whole numbers stay whole
            kind = "Int64" if pd.api.types.is_integer_dtype(found[c].dtype) else object
            found[c], counting[c] = found[c].astype(kind), counting[c].astype(kind)
        return (pd.concat([found, counting], ignore_index=True) if len(found) else counting)[columns]

    return rows.groupBy(*by).cogroup(grouped.groupBy(*by)).applyInPandas(run, schema)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), *[F.col(c).asc() for c in keys])
    return found.where(F.col("score").isNotNull() & ~F.isnan("score")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _counted(found: DataFrame) -> DataFrame:
    return found.groupBy("qid").agg(F.sum("sketched").alias("sketched"), F.sum("compared").alias("compared"))


def approximate(index: CellIndex, queries: DataFrame, qid_col: str, qvec_col: str, k: int = 10, probes: int = 4,
                radius: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((qid, keys, score, rank), (qid, sketched, compared)).  ``radius`` None compares all rows of
    the probed cells."""
    near = cut_lineage(_probed(queries, qid_col, qvec_col, index, probes))
    wanted = near.join(index.blocks.select("cell", "block"), "cell").select("qid", "cell", "block", "unit", "sketch")
    found = cut_lineage(_compare(index, wanted, queries.schema[qid_col].dataType, k, radius))
    return _best(found, index.keys, k).select(F.col("qid").alias(qid_col), *index.keys, "score", "rank"), \
        _counted(found).withColumnRenamed("qid", qid_col)


def exact(index: CellIndex, queries: DataFrame, qid_col: str, qvec_col: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """((qid, keys, score, rank), (qid, compared, blocks_read)); every query that is a vector."""
    kind = queries.schema[qid_col].dataType
    near = cut_lineage(_probed(queries, qid_col, qvec_col, index, len(index.pivots)))
    columns = ["qid", "cell", "block", "unit", "sketch"]
    pairs = near.join(index.blocks, "cell", "inner").select("qid", near["cell"], "block", "unit", "sketch", "place", "angle", "low", "high")
    first = cut_lineage(_compare(index, pairs.where("place = 0").select(columns), kind, k, None))
    bound = _best(first, index.keys, k).groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    # The least angle that a vector of the block can have to the query.
    least = F.greatest(F.lit(0.0), F.col("angle") - F.col("high"), F.col("low") - F.col("angle"))
    reach = F.when(F.col("n") >= k, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth")))) + SLACK).otherwise(F.lit(4.0))
    rest = pairs.where("place > 0").join(bound, "qid", "left").where(least <= F.coalesce(reach, F.lit(4.0)))
    found = cut_lineage(first.unionByName(_compare(index, rest.select(columns), kind, k, None)))
    read = found.where("sketched > 0").groupBy("qid").agg(F.sum("compared").alias("compared"), F.count(F.lit(1)).alias("blocks_read"))
    return _best(found, index.keys, k).select(F.col("qid").alias(qid_col), *index.keys, "score", "rank"), \
        read.withColumnRenamed("qid", qid_col)


def recall(approx: DataFrame, truth: DataFrame, counted: DataFrame, qid_col: str, keys: Sequence[str], total: int, k: int) -> DataFrame:
    """Per query of ``truth``: hits among the exact ``k``, rows sketched and compared, and shares."""
    keys = list(keys)
    hits = truth.select(qid_col, *keys).join(approx.select(qid_col, *keys), [qid_col, *keys], "left_semi").groupBy(qid_col).agg(
        F.count(F.lit(1)).alias("hits"))
    wanted = truth.groupBy(qid_col).agg(F.count(F.lit(1)).alias("wanted"))
    return wanted.join(hits, qid_col, "left").join(counted, qid_col, "left").select(
        qid_col, F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("sketched", F.lit(0)).alias("sketched"),
        F.coalesce("compared", F.lit(0)).alias("compared"),
        (F.coalesce("hits", F.lit(0)) / F.col("wanted")).alias("recall"),
        (F.coalesce("compared", F.lit(0)) / F.lit(float(max(total, 1)))).alias("share_compared"))
