"""Bundle queries over ``lineitem``: one menu per part, offer = (quantity, lowest price)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keys import two_decimals
from tessera.operators import bundles as B
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir
from tessera.sources import read_offer_csv, read_table

MAX_TARGET = 50

_OFFERS_SQL = f"""
offers AS (
  SELECT l_partkey, CAST(l_quantity AS INTEGER) AS amount,
         MIN(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price_cents
  FROM lineitem WHERE l_quantity <= {MAX_TARGET} AND l_quantity >= 1
  GROUP BY 1, 2),
menus AS (
  SELECT l_partkey, list({{'amount': amount, 'price_cents': price_cents}}) AS offers
  FROM offers GROUP BY 1)"""

_FOLD_SQL = f"""
folded AS (
  SELECT l_partkey, list_reduce(range(1, {MAX_TARGET + 1}),
    lambda acc, n: list_append(acc, list_min(list_filter(list_transform(
        list_filter(offers, lambda x: x.amount <= n),
        lambda x: {{'c': acc[n - x.amount + 1].c + x.price_cents, 'o': acc[n - x.amount + 1].o + 1}}),
        lambda y: y.c IS NOT NULL))),
    [{{'c': 0::BIGINT, 'o': 0}}]) AS acc
  FROM menus),
best AS (
  SELECT l_partkey, CAST(i - 1 AS INTEGER) AS n, acc[i].c AS best_cents, acc[i].o AS orders,
         acc[i].c IS NOT NULL AS feasible
  FROM folded, range(2, {MAX_TARGET + 2}) r(i))"""

_FOLD_B_SQL = f"""
folded AS (
  SELECT l_partkey, list_reduce(range(1, {MAX_TARGET + 1}),
    lambda acc, n: list_append(acc, list_min(list_filter(list_transform(
        list_filter(offers, lambda x: x.amount <= n),
        lambda x: {{'c': acc[n - x.amount + 1].c + x.price_cents, 'o': acc[n - x.amount + 1].o + 1,
                   'b': list_sort(list_append(acc[n - x.amount + 1].b, x.amount))}}),
        lambda y: y.c IS NOT NULL))),
    [{{'c': 0::BIGINT, 'o': 0, 'b': []::INTEGER[]}}]) AS acc
  FROM menus),
best AS (
  SELECT l_partkey, CAST(i - 1 AS INTEGER) AS n, acc[i].c AS best_cents, acc[i].b AS bundle
  FROM folded, range(2, {MAX_TARGET + 2}) r(i) WHERE acc[i].c IS NOT NULL)"""


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return B.offers_from_lines(li, "l_partkey", "l_quantity", "l_extendedprice", MAX_TARGET)


@register("bundle_best_price", f"""
WITH {_OFFERS_SQL}, {_FOLD_SQL}
SELECT l_partkey, n, best_cents, orders, feasible FROM best""")
def bundle_best_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.best_bundles(_offers(spark, sf_dir), "l_partkey", MAX_TARGET)


@register("bundle_beaten_offers", f"""
WITH {_OFFERS_SQL}, {_FOLD_SQL}
SELECT o.l_partkey, o.amount, o.price_cents, b.best_cents, b.orders,
       o.price_cents - b.best_cents AS saving_cents
FROM offers o JOIN best b ON o.l_partkey = b.l_partkey AND o.amount = b.n
WHERE b.best_cents < o.price_cents""")
def bundle_beaten_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.beaten_offers(_offers(spark, sf_dir), "l_partkey", MAX_TARGET)


@register("bundle_unit_price_min", f"""
WITH {_OFFERS_SQL}, {_FOLD_SQL},
unit AS (
  SELECT l_partkey, n, best_cents, CAST(best_cents AS DOUBLE) / CAST(n * 100 AS DOUBLE) AS unit_price
  FROM best WHERE feasible),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY unit_price) AS rk FROM unit)
SELECT l_partkey, n, best_cents, unit_price,
       row_number() OVER (PARTITION BY l_partkey ORDER BY n) = 1 AS first
FROM ranked WHERE rk = 1""")
def bundle_unit_price_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = B.best_bundles(_offers(spark, sf_dir), "l_partkey", MAX_TARGET)
    return B.unit_price_minima(best, "l_partkey")


@register("bundle_offer_mix", f"""
WITH {_OFFERS_SQL}, {_FOLD_B_SQL},
parts AS (SELECT l_partkey, n, unnest(bundle) AS amount FROM best)
SELECT l_partkey, n, amount, count(*) AS times FROM parts GROUP BY 1, 2, 3""")
def bundle_offer_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = B.best_bundles(_offers(spark, sf_dir), "l_partkey", MAX_TARGET, with_bundle=True)
    return B.bundle_mix(best, "l_partkey")


@register("bundle_offer_counts", f"""
WITH {_OFFERS_SQL}, {_FOLD_B_SQL}
SELECT l_partkey, n, CAST(len(list_distinct(bundle)) AS INTEGER) AS n_offers,
       CAST(len(bundle) AS INTEGER) AS n_orders FROM best""")
def bundle_offer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = B.best_bundles(_offers(spark, sf_dir), "l_partkey", MAX_TARGET, with_bundle=True)
    return best.where("feasible").select("l_partkey", "n", F.size(F.array_distinct("bundle")).alias("n_offers"),
                                         F.size("bundle").alias("n_orders"))


@register("offer_csv_round_trip", """
SELECT CAST(0 AS BIGINT) AS group_id, CAST(l_quantity AS INTEGER) AS amount, min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price_cents
FROM lineitem WHERE l_quantity >= 1 AND l_quantity = floor(l_quantity) GROUP BY 2""")
def offer_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest price of every quantity, written as an offer menu with two decimals and read back."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("menu", F.lit(0))
    offers = B.offers_from_lines(li, "menu", "l_quantity", "l_extendedprice", 2**31 - 1)
    path = os.path.join(ensure_checkpoint_dir(spark), "offer_csv", uuid.uuid4().hex)
    offers.select("amount", two_decimals(F.col("price_cents") / 100).alias("price")).write.option("header", True).csv(path)
    return read_offer_csv(spark, path)
