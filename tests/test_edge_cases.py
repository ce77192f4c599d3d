"""Edge cases from the test plan: empty inputs, everything blocked, duplicates, nulls."""

from pyspark.sql import functions as F

from tessera.operators import bundles as B
from tessera.operators import chunking as CH
from tessera.operators import contacts as T
from tessera.operators import graph as G
from tessera.operators import schedule as S


def test_empty_inputs(spark):
    offers = spark.createDataFrame([], "group_id BIGINT, amount INT, price_cents BIGINT")
    assert B.best_bundles(offers, "group_id", 10).count() == 0
    cat = spark.createDataFrame([], "collection STRING, id BIGINT, duration DOUBLE, benefit BIGINT")
    assert S.best_value(cat, "collection").count() == 0
    assert S.candidates(cat, "collection").count() == 0
    edges = spark.createDataFrame([], "g STRING, u BIGINT, v BIGINT")
    assert G.simple_cycles(edges, ["g"]).count() == 0
    assert G.hamiltonian_paths(edges, ["g"]).count() == 0
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert CH.fixed_chunks(docs).count() == 0 and CH.recursive_chunks(docs).count() == 0


def test_all_hours_blocked_and_too_long(spark):
    cat = spark.createDataFrame([("a", 0, 3.0, 10), ("b", 1, 30.0, 99)],
                                "collection STRING, id BIGINT, duration DOUBLE, benefit BIGINT")
    rows = S.best_value(cat, "collection", 2, 1, list(range(24))).collect()
    assert {r["collection"]: (r["value"], r["feasible"]) for r in rows} == {"a": (0, False), "b": (0, False)}
    open_day = {r["collection"]: r["feasible"] for r in S.best_value(cat, "collection").collect()}
    assert open_day == {"a": True, "b": False}
    win = {r["collection"]: r["value"] for r in S.best_value(cat, "collection", 1, 1, [], mode="window").collect()}
    assert win == {"a": 80, "b": 0}
    assert S.best_plan(cat, "collection", 1, 1, list(range(24))).count() == 0
    two_days = {r["collection"]: r["value"] for r in S.best_value(cat, "collection", 1, 2).collect()}
    assert two_days == {"a": 160, "b": 99}


def test_duplicates_and_nulls(spark):
    offers = spark.createDataFrame([(1, 2, 300), (1, 2, 250), (1, None, 5), (None, 3, 100)],
                                   "group_id BIGINT, amount INT, price_cents BIGINT")
    best = {(r["group_id"], r["n"]): r["best_cents"] for r in B.best_bundles(offers, "group_id", 4).collect()}
    assert best[(1, 2)] == 250 and best[(1, 4)] == 500 and best[(1, 1)] is None
    assert best[(None, 3)] == 100
    rows = spark.createDataFrame([("+1", 1, "x"), ("+1", 3, "z"), ("+1", 2, "y")], "k STRING, d INT, v STRING")
    up = T.upsert_latest(rows, ["k"], ["d"]).collect()
    assert [(r["k"], r["d"], r["v"]) for r in up] == [("+1", 3, "z")]
    short = spark.createDataFrame([("abc",)], "t STRING")
    from tessera.functions import truncate_ellipsis
    assert short.select(truncate_ellipsis(F.col("t"), 65)).first()[0] == "abc…"
