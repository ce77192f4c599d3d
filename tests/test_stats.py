import hashlib

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import diagnostics as D
from tessera.operators import experiment as X
from tessera.operators.indexing import dense_index


def test_pca_t2_mean_invariant(spark):
    rng = np.random.default_rng(0)
    M = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6))
    df = spark.createDataFrame([(i, M[i].tolist()) for i in range(400)], "id BIGINT, v ARRAY<DOUBLE>")
    sc = D.pca_scores(df, "id", "v", 3).collect()
    mean_t2 = np.mean([r["t2"] for r in sc])
    assert abs(mean_t2 - 3 * 399 / 400) < 1e-6
    assert all(r["spe"] > -1e-9 for r in sc)
    cov = {(r["i"], r["j"]): r["cov"] for r in D.covariance(df, "v").collect()}
    C = np.cov(M.T)
    assert all(abs(cov[(i, j)] - C[i, j]) < 1e-9 for i in range(6) for j in range(i, 6))


def test_permutation_diffs_match_brute_force(spark):
    rng = np.random.default_rng(1)
    units = [(int(i), float(v)) for i, v in zip(range(300), rng.exponential(10, 300))]
    df = spark.createDataFrame(units, "user_id BIGINT, total_value DOUBLE")
    got = {r["perm"]: r["diff"] for r in X.permutation_diffs(df, "user_id", "total_value", 130, 12).collect()}
    for p in range(1, 13):
        order = sorted(units, key=lambda u: hashlib.md5(f"{u[0]}:{p}".encode()).hexdigest())
        a = [v for _, v in order[:130]]
        b = [v for _, v in order[130:]]
        assert abs(got[p] - (np.mean(a) - np.mean(b))) < 1e-9


def test_permutations_shuffle_counts_only(spark):
    """Ties of no unit, one unit, nothing first, and a plan that never explodes units."""
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(500)], "user_id BIGINT, total_value DOUBLE")
    for first in (0, 1, 250, 500):
        rows = {r["perm"]: r for r in X.permutation_diffs(df, "user_id", "total_value", first, 3).collect()}
        for p in (1, 2, 3):
            order = sorted(range(500), key=lambda i: hashlib.md5(f"{i}:{p}".encode()).hexdigest())
            want = [float(i % 7) for i in order[:first]]
            assert rows[p]["mean_first"] == (None if not first else np.mean(want)) or abs(rows[p]["mean_first"] - np.mean(want)) < 1e-9
    assert X.permutation_diffs(df.limit(0), "user_id", "total_value", 0, 2).count() == 2
    plan = X.permutation_diffs(df, "user_id", "total_value", 250, 3)._jdf.queryExecution().toString()
    assert "Generate" not in plan


def test_arms_balance_and_retention(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "user_id BIGINT").withColumn("arm", X.arm_of(F.col("user_id")))
    exp = {i: "AB"[int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 2] for i in range(1000)}
    assert all(exp[r["user_id"]] == r["arm"] for r in df.collect())
    bal = X.balance(df, "arm").collect()
    assert sum(r["n_units"] for r in bal) == 1000 and bal[0]["chi2"] >= 0
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00", "view", 1.0), (1, "2024-01-02 09:00:00", "purchase", 5.0),
                                (2, "2024-01-03 00:00:00", "view", 0.0), (2, "2024-01-10 00:00:00", "view", 0.0)],
                               "user_id BIGINT, ts STRING, event_type STRING, value DOUBLE") \
        .withColumn("ts", F.to_timestamp("ts"))
    u = X.unit_metrics(ev, "user_id", "ts", "event_type", "value").withColumn("arm", F.lit("A"))
    r = X.retention(u, "arm").first()
    assert r["retention_d1"] == 0.5 and r["retention_d7"] == 0.5 and r["revenue_per_unit"] == 2.5


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).alias("k")).repartition(7)
    rows = dense_index(df, ["k"], "i").collect()
    ordered = sorted(rows, key=lambda r: r["k"])
    assert [r["i"] for r in ordered] == list(range(5000))


def test_pca_cross_validation(spark):
    rng = np.random.default_rng(4)
    M = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, M[i].tolist()) for i in range(200)], "id BIGINT, v ARRAY<DOUBLE>")
    rows = D.cross_validate(df, "id", "v", 2, folds=4).collect()
    assert len(rows) == 4 and sum(r["n_test"] for r in rows) == 200
    assert all(r["n_train"] + r["n_test"] == 200 and r["mean_spe_test"] >= 0 for r in rows)
    fold = np.array([int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 4 for i in range(200)])
    for r in rows:
        train, test = M[fold != r["fold"]], M[fold == r["fold"]]
        z = lambda x: (x - train.mean(axis=0)) / train.std(axis=0, ddof=1)
        values, vectors = np.linalg.eigh(np.cov(z(train).T))
        top = vectors[:, ::-1][:, :2]
        spe = (z(test) ** 2).sum(axis=1) - ((z(test) @ top) ** 2).sum(axis=1)
        assert abs(r["mean_spe_test"] - spe.mean()) < 1e-8
        assert abs(r["explained"] - values[::-1][:2].sum() / values.sum()) < 1e-9


def test_an_empty_arm_has_no_mean(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "user_id BIGINT, total_value DOUBLE")
    rows = X.permutation_diffs(df, "user_id", "total_value", 20, 3).collect()
    assert all(r["mean_rest"] is None and r["diff"] is None and abs(r["mean_first"] - 9.5) < 1e-9 for r in rows)
