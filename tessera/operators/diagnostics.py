"""Principal-component diagnostics for vector columns.

* ``column_moments``: per-dimension count, mean and sample standard deviation.
* ``covariance``: sample covariance of every dimension pair from per-task partial Gram
  matrices (``mapInPandas`` emits ``d x d`` partial sums per task; one small aggregate
  merges them) -- the data is scanned once and never paired row by row.
* ``fit_pca`` / ``pca_scores``: standardise and fit with ``pyspark.ml`` (distributed
  covariance, eigen-decomposition of the ``d x d`` matrix on the driver), then per row
  Hotelling's T^2 (leverage) and the squared prediction error (residual), flagged above
  an upper percentile.
* ``variance_table``: explained and cumulative variance per component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package


def column_moments(df: DataFrame, vec_col: str) -> DataFrame:
    return (
        df.select(F.posexplode(vec_col).alias("pos", "v"))
        .groupBy("pos").agg(F.count("v").alias("n"), F.avg(F.col("v").cast("double")).alias("mean"),
                            F.stddev_samp(F.col("v").cast("double")).alias("std"))
    )


_GRAM_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("si", T.DoubleType()),
    T.StructField("sj", T.DoubleType()), T.StructField("sij", T.DoubleType()),
])


def gram_sums(df: DataFrame, vec_col: str, part: Column) -> DataFrame:
    """``(part, i, j, n, si, sj, sij)`` for ``i <= j``: per-task sums of x and of xy by part, merged.
    One scan; parts x dimension^2 rows leave a task."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for pdf in batches:
            for k, rows in pdf.groupby("part", sort=True):
                X = np.stack([np.asarray(v, dtype=np.float64) for v in rows["v"]])
                n, s, g = sums.get(k, (0, 0.0, 0.0))
                sums[k] = (n + X.shape[0], s + X.sum(axis=0), g + X.T @ X)
        for k, (n, s, g) in sums.items():
            ii, jj = np.triu_indices(len(s))
            yield pd.DataFrame({"part": np.full(len(ii), k, dtype="int32"), "i": ii.astype("int32"), "j": jj.astype("int32"),
                                "n": np.full(len(ii), n), "si": s[ii], "sj": s[jj], "sij": g[ii, jj]})

    ship_package(df.sparkSession)
    parts = df.select(part.alias("part"), F.col(vec_col).alias("v")).mapInPandas(partial, _GRAM_SCHEMA)
    return parts.groupBy("part", "i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "si", "sj", "sij")))


def covariance(df: DataFrame, vec_col: str) -> DataFrame:
    """``(i, j, cov)`` for ``i <= j`` from merged per-task sums (n, sum x, sum xy)."""
    return gram_sums(df, vec_col, F.lit(0)).select(
        "i", "j", ((F.col("sij") - F.col("si") * F.col("sj") / F.col("n")) / (F.col("n") - 1)).alias("cov"))


def fit_pca(df: DataFrame, vec_col: str, k: int):
    """Fit scaler and PCA; returns (scaler_model, pca_model, scaled DataFrame)."""
    vec = df.withColumn("_x", array_to_vector(F.col(vec_col).cast("array<double>")))
    scaler = StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True).fit(vec)
    scaled = scaler.transform(vec)
    pca = PCA(k=k, inputCol="_z", outputCol="_t").fit(scaled)
    return scaler, pca, scaled


def variance_table(pca_model, spark) -> DataFrame:
    ev = [float(x) for x in pca_model.explainedVariance.toArray()]
    cum = np.cumsum(ev).tolist()
    rows = [(i + 1, ev[i], float(cum[i])) for i in range(len(ev))]
    return spark.createDataFrame(rows, "component INT, explained_variance DOUBLE, cumulative DOUBLE")


def pca_scores(df: DataFrame, id_col: str, vec_col: str, k: int, upper: float = 0.95) -> DataFrame:
    """Per row: T^2 = sum_j t_j^2 / lambda_j and SPE = |z|^2 - |t|^2 with flags above the
    ``upper`` percentile of each statistic (``percentile_approx``)."""
    scaler, pca, scaled = fit_pca(df, vec_col, k)
    std = scaler.std.toArray()
    total_var = float(np.sum(std > 0))
    lam = [float(x) * total_var for x in pca.explainedVariance.toArray()]
    scored = pca.transform(scaled).select(
        id_col, vector_to_array("_z").alias("z"), vector_to_array("_t").alias("t"))
    lam_arr = F.array(*[F.lit(v) for v in lam])
    t2 = F.aggregate(F.arrays_zip(F.col("t").alias("t"), lam_arr.alias("l")), F.lit(0.0),
                     lambda acc, x: acc + x["t"] * x["t"] / x["l"])
    sq = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x)
    out = scored.select(id_col, t2.alias("t2"), (sq(F.col("z")) - sq(F.col("t"))).alias("spe"))
    lim = out.agg(F.percentile_approx("t2", upper).alias("t2_lim"),
                  F.percentile_approx("spe", upper).alias("spe_lim")).first()
    return out.select(id_col, "t2", "spe", (F.col("t2") > F.lit(lim["t2_lim"])).alias("t2_outlier"),
                      (F.col("spe") > F.lit(lim["spe_lim"])).alias("spe_outlier"))


def identities(df: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """What must hold of a component model, as ``(name, value)``: ``trace`` (sum of all eigenvalues: the
    number of columns that vary), ``residual_j`` (length of C v - lambda v of the first ``k``
    components on the correlation matrix), ``dot_i_j`` of their vectors, ``t2_sum`` (k (n - 1)) and
    ``spe_sum`` less what the other components explain (0)."""
    scaler, pca, scaled = fit_pca(df, vec_col, k)
    d = scaler.std.size
    cov = np.zeros((d, d))
    for r in covariance(df, vec_col).collect():  # dimension squared
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["cov"]
    std = np.sqrt(np.diag(cov))
    scale = np.divide(1.0, std, out=np.zeros(d), where=std > 0)
    corr = cov * np.outer(scale, scale)
    trace = float((std > 0).sum())
    values, vectors = pca.explainedVariance.toArray() * trace, pca.pc.toArray()
    whole = PCA(k=d, inputCol="_z", outputCol="_all").fit(scaled).explainedVariance.toArray()
    rows = [("trace", float(whole.sum() * np.trace(corr)))]
    rows += [(f"residual_{j + 1}", float(np.linalg.norm(corr @ vectors[:, j] - values[j] * vectors[:, j]))) for j in range(k)]
    rows += [(f"dot_{i + 1}_{j + 1}", float(vectors[:, i] @ vectors[:, j])) for i in range(k) for j in range(i, k)]
    total = pca_scores(df, id_col, vec_col, k).agg(F.sum("t2").alias("t2"), F.sum("spe").alias("spe"), F.count(F.lit(1)).alias("n")).first()
    rows += [("t2_sum", float(total["t2"])), ("spe_sum_less_rest", float(total["spe"] - (total["n"] - 1) * (trace - values.sum())))]
    return df.sparkSession.createDataFrame(rows, "name STRING, value DOUBLE")


def fold_of(id_col: Column, folds: int) -> Column:
    """The fold of a row: the first 32 bits of its id's md5, modulo the folds."""
    return (F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def cross_validate(df: DataFrame, id_col: str, vec_col: str, k: int, folds: int = 5) -> DataFrame:
    """k-fold validation of the component model: rows go to folds by a hash of their id; for each
    fold the components are those of the other folds, and the held-out rows' squared prediction
    error is summarised.  Output ``(fold, n_train, n_test, explained, mean_spe_test)``.

    One scan: sums and Gram matrices are additive, so the training sums of a fold are all sums
    less its own, and the held-out error follows from its own sums.  The driver gets folds x
    dimension^2 numbers and solves one eigenproblem of that dimension a fold."""
    sums = gram_sums(df, vec_col, fold_of(F.col(id_col), folds)).toPandas()
    d = int(sums["i"].max()) + 1 if len(sums) else 0
    n, s, g = np.zeros(folds), np.zeros((folds, d)), np.zeros((folds, d, d))
    for r in sums.itertuples():
        n[r.part] = r.n
        s[r.part, r.i], s[r.part, r.j] = r.si, r.sj
        g[r.part, r.i, r.j] = g[r.part, r.j, r.i] = r.sij
    rows = []
    for f in range(folds):
        m = n.sum() - n[f]
        if m < 2:
            rows.append((f, int(m), int(n[f]), None, None))
            continue
        mean = (s.sum(axis=0) - s[f]) / m
        cov = ((g.sum(axis=0) - g[f]) - m * np.outer(mean, mean)) / (m - 1)
        std = np.sqrt(np.maximum(np.diag(cov), 0))
        scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
        values, vectors = np.linalg.eigh(cov * np.outer(scale, scale))
        top = vectors[:, ::-1][:, :k]
        held = (g[f] - np.outer(s[f], mean) - np.outer(mean, s[f]) + n[f] * np.outer(mean, mean)) * np.outer(scale, scale)
        error = None if not n[f] else float((np.trace(held) - np.trace(top.T @ held @ top)) / n[f])
        rows.append((f, int(m), int(n[f]), float(values[::-1][:k].sum() / values.sum()), error))
    return df.sparkSession.createDataFrame(rows, "fold INT, n_train BIGINT, n_test BIGINT, explained DOUBLE, mean_spe_test DOUBLE")
