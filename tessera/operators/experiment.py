"""Experiment statistics: deterministic arm assignment, per-arm summaries, permutation
tests and retention against monetisation.

All work is per unit first (one row per user, partial-aggregated from events), so the
permutation test hashes users -- never events -- for every permutation, in two scans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.parallelism import spread
from tessera.session import ship_package

HASH_BUCKETS_HEX = 3  # leading hex digits of md5 used to bucket a permutation's order


def arm_of(id_col: Column, n_arms: int = 2, salt: str = "") -> Column:
    """Deterministic arm from the first 8 hex digits of ``md5(id || salt)``; 'A', 'B', ..."""
    h = F.md5(F.concat(id_col.cast("string"), F.lit(salt)))
    idx = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % n_arms
    names = F.array(*[F.lit(chr(65 + i)) for i in range(n_arms)])
    return F.element_at(names, (idx + 1).cast("int"))


def unit_metrics(events: DataFrame, unit_col: str, ts_col: str, type_col: str, value_col: str,
                 purchase_type: str = "purchase") -> DataFrame:
    """One row per unit: events, total value, purchase value, first day and active days.

    ``collect_set`` of dates is bounded by the number of distinct days in the data.
    """
    day = F.to_date(F.col(ts_col))
    return events.groupBy(unit_col).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(value_col).alias("total_value"),
        F.sum(F.when(F.col(type_col) == purchase_type, F.col(value_col)).otherwise(F.lit(0.0))).alias("purchase_value"),
        F.min(day).alias("first_day"),
        F.collect_set(day).alias("days"),
    )


def arm_summary(units: DataFrame, arm_col: str, value_col: str, control: str = "A") -> DataFrame:
    """Per arm: units, mean, sample variance and lift of the mean over the control arm.

    The control mean is spread by a window over the per-arm table (one row per arm).
    """
    per = units.groupBy(arm_col).agg(
        F.count(F.lit(1)).alias("n_units"), F.avg(value_col).alias("mean"),
        F.var_samp(value_col).alias("var"))
    ctrl = F.max(F.when(F.col(arm_col) == control, F.col("mean"))).over(Window.partitionBy(F.lit(1)))
    return per.select(arm_col, "n_units", "mean", "var", (F.col("mean") / ctrl - 1).alias("lift"))


def balance(units: DataFrame, arm_col: str, n_arms: int = 2) -> DataFrame:
    """Units per arm against an equal split and the chi-square statistic."""
    per = units.groupBy(arm_col).agg(F.count(F.lit(1)).alias("n_units"))
    total = F.sum("n_units").over(Window.partitionBy(F.lit(1)))
    exp = total / F.lit(float(n_arms))
    contrib = (F.col("n_units") - exp) * (F.col("n_units") - exp) / exp
    return per.select(arm_col, "n_units", exp.alias("expected"), contrib.alias("chi2_part")) \
        .withColumn("chi2", F.sum("chi2_part").over(Window.partitionBy(F.lit(1))))


def _hashes(ids: list[str], perm: int) -> list[str]:
    return [hashlib.md5(f"{i}:{perm}".encode()).hexdigest() for i in ids]


def permutation_diffs(units: DataFrame, id_col: str, value_col: str, n_first: int,
                      permutations: int) -> DataFrame:
    """Difference of means ``first - rest`` for each permutation ``1..permutations``,
    where "first" is the ``n_first`` units with the smallest ``md5(id:perm)``.

    Units are never multiplied by permutations in a shuffle.  A scan counts and sums them per
    permutation and hash prefix, in arrays that a task keeps for all its rows; what is shuffled has
    at most ``2 ** (4 * HASH_BUCKETS_HEX)`` rows a permutation and task.  A running count finds the
    prefix that holds the boundary, and a second scan passes on the units of that prefix only, to be
    ranked exactly."""
    buckets = 16 ** HASH_BUCKETS_HEX
    ship_package(units.sparkSession)
    rows = spread(units.select(F.col(id_col).cast("string").alias("id"), F.col(value_col).cast("double").alias("v")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((permutations, buckets), np.int64)
        s = np.zeros((permutations, buckets))
        for pdf in batches:
            ids, v = pdf["id"].tolist(), pdf["v"].to_numpy()
            for p in range(permutations):
                at = np.array([int(h[:HASH_BUCKETS_HEX], 16) for h in _hashes(ids, p + 1)], np.int64)
                n[p] += np.bincount(at, minlength=buckets)
                s[p] += np.bincount(at, np.nan_to_num(v), minlength=buckets)
        for p in range(permutations):
            at = np.flatnonzero(n[p])
            yield pd.DataFrame({"perm": np.full(len(at), p + 1, np.int32), "b": at.astype(np.int32), "n": n[p, at], "s": s[p, at]})

    counts = rows.mapInPandas(count, "perm int, b int, n bigint, s double").groupBy("perm", "b").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"))
    w = Window.partitionBy("perm").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select("perm", "b", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"),
                          F.coalesce(F.sum("s").over(w), F.lit(0.0)).alias("before_sum"))
    # The prefix whose units pass the boundary, or reach it with the last of them: a row a permutation.
    edge = below.where((F.col("before") < n_first) & (F.col("before") + F.col("n") >= n_first)).collect()
    known = {r["perm"]: r for r in edge}
    limits = units.sparkSession.createDataFrame(
        [(p, int(known[p]["before"]), float(known[p]["before_sum"])) if p in known else (p, 0, 0.0) for p in range(1, permutations + 1)],
        "perm int, before bigint, before_sum double")
    tot = units.agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("s")).first()
    n_all, s_all = int(tot["n"]), float(tot["s"] or 0.0)
    prefix = {p: f"{r['b']:0{HASH_BUCKETS_HEX}x}" for p, r in known.items()}

    def boundary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, v = pdf["id"].tolist(), pdf["v"].to_numpy()
            found = [(p, h, k) for p, start in prefix.items() for k, h in enumerate(_hashes(ids, p)) if h.startswith(start)]
            if found:
                yield pd.DataFrame({"perm": np.array([f[0] for f in found], np.int32), "h": [f[1] for f in found], "v": v[[f[2] for f in found]]})

    ranked = rows.mapInPandas(boundary, "perm int, h string, v double").withColumn(
        "r", F.row_number().over(Window.partitionBy("perm").orderBy("h"))).join(limits, "perm")
    inside = ranked.where(F.col("r") <= F.lit(n_first) - F.col("before")).groupBy("perm").agg(F.sum("v").alias("inside"))
    first_sum = limits.join(inside, "perm", "left").select(
        "perm", (F.col("before_sum") + F.coalesce("inside", F.lit(0.0))).alias("_sa"))
    # An empty side has no mean.
    mean_first = F.try_divide(F.col("_sa"), F.lit(float(n_first)))
    mean_rest = F.try_divide(F.lit(s_all) - F.col("_sa"), F.lit(float(n_all - n_first)))
    return first_sum.select("perm", mean_first.alias("mean_first"), mean_rest.alias("mean_rest"),
                            (mean_first - mean_rest).alias("diff"))


def retention(units: DataFrame, arm_col: str) -> DataFrame:
    """Per arm: day-1 and day-7 retention (active exactly 1 / 7 days after the first
    day) and purchase value per unit and share of paying units."""
    r1 = F.array_contains("days", F.date_add("first_day", 1)).cast("double")
    r7 = F.array_contains("days", F.date_add("first_day", 7)).cast("double")
    return units.groupBy(arm_col).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.avg(r1).alias("retention_d1"), F.avg(r7).alias("retention_d7"),
        F.avg("purchase_value").alias("revenue_per_unit"),
        F.avg((F.col("purchase_value") > 0).cast("double")).alias("paying_share"))
