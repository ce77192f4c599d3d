"""Statistics queries: vector moments and PCA diagnostics over ``embeddings``; experiment
statistics over ``events`` with users as units and arms from a hash of the user id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import diagnostics as D
from tessera.operators import experiment as X
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources import read_table

PCA_K = 5
PERMUTATIONS = 200

_ARMS_SQL = """
units AS (
  SELECT user_id, sum(value) AS total_value,
         sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END) AS purchase_value,
         min(CAST(ts AS DATE)) AS first_day
  FROM events GROUP BY user_id),
arms AS (
  SELECT *, CASE WHEN CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 2 = 0
                 THEN 'A' ELSE 'B' END AS arm
  FROM units)"""

_PERM_SQL = f"""
na AS (SELECT count(*) AS n FROM arms WHERE arm = 'A'),
tot AS (SELECT count(*) AS n, sum(total_value) AS s FROM units),
p AS (
  SELECT u.user_id, u.total_value AS v, CAST(r.range AS INTEGER) AS perm,
         md5(CAST(u.user_id AS VARCHAR) || ':' || CAST(r.range AS VARCHAR)) AS h
  FROM units u CROSS JOIN range(1, {PERMUTATIONS + 1}) r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY perm ORDER BY h) AS rn FROM p),
perms AS (
  SELECT perm, sum(v) FILTER (WHERE rn <= na.n) / CAST(na.n AS DOUBLE) AS mean_first,
         (tot.s - sum(v) FILTER (WHERE rn <= na.n)) / CAST(tot.n - na.n AS DOUBLE) AS mean_rest
  FROM ranked CROSS JOIN na CROSS JOIN tot GROUP BY perm, na.n, tot.n, tot.s)"""


def _emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings")


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    u = X.unit_metrics(ev, "user_id", "ts", "event_type", "value")
    return u.withColumn("arm", X.arm_of(F.col("user_id")))


@register("embedding_moments", """
SELECT CAST(pos - 1 AS INTEGER) AS pos, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std
FROM (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
GROUP BY pos""", rounded=('mean', 'std'))
def embedding_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.column_moments(_emb(spark, sf_dir), "embedding")


@register("embedding_covariance", """
WITH x AS (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p, unnest(embedding)::DOUBLE AS v
  FROM embeddings)
SELECT a.p AS i, b.p AS j, covar_samp(a.v, b.v) AS cov
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.p <= b.p GROUP BY 1, 2""", rounded=('cov',))
def embedding_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.covariance(_emb(spark, sf_dir), "embedding")


@register("pca_variance")
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pca, _ = D.fit_pca(_emb(spark, sf_dir), "embedding", PCA_K)
    return D.variance_table(pca, spark)


@register("pca_diagnostics")
def pca_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.pca_scores(_emb(spark, sf_dir), "vec_id", "embedding", PCA_K)


@register("ab_balance", f"""
WITH {_ARMS_SQL},
per AS (SELECT arm, count(*) AS n_units FROM arms GROUP BY arm),
e AS (SELECT arm, n_units, sum(n_units) OVER () / 2.0::DOUBLE AS expected FROM per)
SELECT arm, n_units, expected, (n_units - expected) * (n_units - expected) / expected AS chi2_part,
       sum((n_units - expected) * (n_units - expected) / expected) OVER () AS chi2
FROM e""", rounded=('expected', 'chi2_part', 'chi2'))
def ab_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.balance(_units(spark, sf_dir), "arm")


@register("ab_summary", f"""
WITH {_ARMS_SQL},
per AS (SELECT arm, count(*) AS n_units, avg(total_value) AS mean, var_samp(total_value) AS var FROM arms GROUP BY arm)
SELECT arm, n_units, mean, var, mean / max(CASE WHEN arm = 'A' THEN mean END) OVER () - 1 AS lift FROM per""", rounded=('mean', 'var', 'lift'))
def ab_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.arm_summary(_units(spark, sf_dir), "arm", "total_value")


def _n_control(units: DataFrame) -> int:
    return units.where(F.col("arm") == "A").count()


@register("ab_permutation", f"""
WITH {_ARMS_SQL}, {_PERM_SQL}
SELECT perm, mean_first, mean_rest, mean_first - mean_rest AS diff FROM perms""", rounded=('mean_first', 'mean_rest', 'diff'), decimals=6)
def ab_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = cut_lineage(_units(spark, sf_dir).select("user_id", "arm", "total_value"))
    return X.permutation_diffs(units, "user_id", "total_value", _n_control(units), PERMUTATIONS)


@register("ab_pvalue", f"""
WITH {_ARMS_SQL}, {_PERM_SQL},
obs AS (SELECT avg(total_value) FILTER (WHERE arm = 'A') - avg(total_value) FILTER (WHERE arm = 'B') AS d FROM arms)
SELECT obs.d AS observed_diff, count(*) AS permutations,
       avg(CASE WHEN abs(mean_first - mean_rest) >= abs(obs.d) THEN 1.0 ELSE 0.0 END)::DOUBLE AS p_value
FROM perms CROSS JOIN obs GROUP BY obs.d""", rounded=('observed_diff', 'p_value'), decimals=6)
def ab_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = cut_lineage(_units(spark, sf_dir).select("user_id", "arm", "total_value"))
    obs = units.groupBy().agg(
        (F.avg(F.when(F.col("arm") == "A", F.col("total_value")))
         - F.avg(F.when(F.col("arm") == "B", F.col("total_value")))).alias("observed_diff")).first()[0]
    diffs = X.permutation_diffs(units, "user_id", "total_value", _n_control(units), PERMUTATIONS)
    return diffs.groupBy().agg(
        F.lit(obs).alias("observed_diff"), F.count(F.lit(1)).alias("permutations"),
        F.avg((F.abs("diff") >= F.lit(abs(obs))).cast("double")).alias("p_value"))


@register("ab_retention", f"""
WITH {_ARMS_SQL},
flags AS (
  SELECT a.user_id, a.arm, a.purchase_value,
         max(CASE WHEN CAST(e.ts AS DATE) = a.first_day + 1 THEN 1.0 ELSE 0.0 END) AS r1,
         max(CASE WHEN CAST(e.ts AS DATE) = a.first_day + 7 THEN 1.0 ELSE 0.0 END) AS r7
  FROM arms a JOIN events e USING (user_id) GROUP BY 1, 2, 3)
SELECT arm, count(*) AS n_units, avg(r1)::DOUBLE AS retention_d1, avg(r7)::DOUBLE AS retention_d7,
       avg(purchase_value) AS revenue_per_unit,
       avg(CASE WHEN purchase_value > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS paying_share
FROM flags GROUP BY arm""", rounded=('retention_d1', 'retention_d7', 'revenue_per_unit', 'paying_share'))
def ab_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.retention(_units(spark, sf_dir), "arm")


@register("pca_cross_validation")
def pca_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.cross_validate(_emb(spark, sf_dir), "vec_id", "embedding", PCA_K, folds=5)


@register("pca_identities", f"""
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
varying AS (SELECT count(*) AS d FROM (SELECT pos FROM x GROUP BY pos HAVING stddev_samp(v) > 0))
SELECT 'trace' AS name, d::DOUBLE AS value FROM varying
UNION ALL SELECT 'residual_' || j, 0.0 FROM range(1, {PCA_K + 1}) t(j)
UNION ALL SELECT 'dot_' || i || '_' || j, CASE WHEN i = j THEN 1.0 ELSE 0.0 END
  FROM range(1, {PCA_K + 1}) a(i) JOIN range(1, {PCA_K + 1}) b(j) ON i <= j
UNION ALL SELECT 't2_sum', {PCA_K}.0 * (count(*) - 1) FROM embeddings
UNION ALL SELECT 'spe_sum_less_rest', 0.0""", rounded=("value",), decimals=6)
def pca_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eigenpairs, scores and residuals of the component model against what must hold of them."""
    out = D.identities(_emb(spark, sf_dir), "vec_id", "embedding", PCA_K)
    return out.select("name", (F.col("value") + F.lit(0.0)).alias("value"))


@register("pca_fold_counts", """
WITH f AS (SELECT CAST(('0x' || substr(md5(vec_id::VARCHAR), 1, 8)) AS BIGINT) % 5 AS fold FROM embeddings),
n AS (SELECT r.range AS fold, count(f.fold) AS n_test FROM range(0, 5) r LEFT JOIN f ON f.fold = r.range GROUP BY 1)
SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n_test) OVER () - n_test AS BIGINT) AS n_train, n_test FROM n""")
def pca_fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each fold of ``pca_cross_validation`` learns from and holds out."""
    return D.cross_validate(_emb(spark, sf_dir), "vec_id", "embedding", PCA_K, folds=5).select("fold", "n_train", "n_test")
