"""Neighbour search by cells against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.operators import cells


def vectors(seed, n, width=16, centres=0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, width))
    if centres:
        c = rng.standard_normal((centres, width))
        v = c[rng.integers(centres, size=n)] + v * 0.15
    return v


def frame(spark, v, extra=(), key="id"):
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)] + list(extra)
    return spark.createDataFrame(rows, f"{key} BIGINT, vec ARRAY<DOUBLE>").repartition(3)


def brute(v, q, k):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    s = np.round(u @ (q / np.linalg.norm(q)), 9)
    return [(int(i), float(s[i])) for i in np.lexsort((np.arange(len(v)), -s))[:k]]


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0])]


@pytest.mark.parametrize("centres,block", [(0, 4096), (0, 20), (6, 20)])
def test_exact_equals_brute_force(spark, monkeypatch, centres, block):
    monkeypatch.setattr(cells, "BLOCK", block)
    v = np.concatenate([vectors(1, 300, centres=centres), vectors(1, 300, centres=centres)[:40]])  # with ties
    index = cells.build(frame(spark, v, ODD[:5]), ["id"], "vec", cells=6, bits=64)
    queries = frame(spark, v[::30] + 0.01, ODD, "q")
    got, read = cells.exact(index, queries, "q", "vec", k=5)
    rows = {}
    for r in got.collect():
        rows.setdefault(r[0], []).append((r["rank"], r[1], r["score"]))
    for j, q in enumerate(v[::30] + 0.01):
        want = brute(v, q, 5)
        mine = sorted(rows[j])
        assert [m[1] for m in mine] == [w[0] for w in want] and [m[2] for m in mine] == pytest.approx([w[1] for w in want], abs=2e-9)
    assert set(rows) == set(range(len(v[::30])))
    compared = [r["compared"] for r in read.collect()]
    assert max(compared) <= len(v)
    if centres:  # cells far from a query are left out by the bound
        assert np.mean(compared) < 0.7 * len(v)


def test_approximate_finds_most_with_few_comparisons(spark):
    v = vectors(2, 2000, 64)
    index = cells.build(frame(spark, v), ["id"], "vec")
    queries = frame(spark, v[::50], key="q")
    found, counted = cells.approximate(index, queries, "q", "vec", k=10, probes=16, radius=232)
    hits = 0
    rows = {}
    for r in found.collect():
        rows.setdefault(r[0], set()).add(r[1])
    for i, j in enumerate(range(0, 2000, 50)):
        hits += len(rows[i] & {w[0] for w in brute(v, v[j], 10)})
    assert hits >= 0.9 * 10 * len(rows)
    assert all(r["compared"] < 0.2 * 2000 and r["sketched"] == 2000 for r in counted.collect())
    few, counted = cells.approximate(index, queries, "q", "vec", k=10, probes=2)
    assert few.groupBy("q").count().where("count > 10").count() == 0
    assert all(r["compared"] == r["sketched"] < 2000 for r in counted.collect())


def test_hot_cell_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 16)
    v = np.repeat(vectors(3, 3, 8), 100, axis=0)
    index = cells.build(frame(spark, v), ["id"], "vec", cells=4, bits=64)
    assert index.blocks.agg(F.max("n")).first()[0] < 64 and index.blocks.agg(F.sum("n")).first()[0] == 300
    queries = frame(spark, v[[0, 100, 200]], key="q")
    got, _ = cells.exact(index, queries, "q", "vec", k=4)
    assert {(r[0], r[1]) for r in got.collect()} == {(q, 100 * q + i) for q in range(3) for i in range(4)}
    none = queries.limit(0)
    assert [f.count() for f in cells.exact(index, none, "q", "vec")] == [0, 0]
    empty = cells.build(none.withColumnRenamed("q", "id"), ["id"], "vec")
    assert [f.count() for f in cells.approximate(empty, queries, "q", "vec")] == [0, 0]
    with pytest.raises(ValueError):
        cells.build(none, ["q"], "vec", bits=10)


def test_vectors_are_placed_few_at_a_time():
    """A pass makes many rows of one; whole input batches at once took 16 times their size."""
    import pandas as pd

    frames = list(cells._slices([pd.DataFrame({"a": range(2 * cells.TOGETHER + 1)})]))
    assert [len(f) for f in frames] == [cells.TOGETHER, cells.TOGETHER, 1]
    assert [x for f in frames for x in f["a"]] == list(range(2 * cells.TOGETHER + 1))
