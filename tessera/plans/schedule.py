"""Catalog and schedule queries over ``part`` used as a product catalog (brand = collection)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keys import compose_key, parse_key
from tessera.operators import catalog as C
from tessera.operators import schedule as S
from tessera.plans.registry import register
from tessera.sources import read_table

# Query parameters: one day, two slots, hours 1-13, 15 and 16 blocked.
DAYS = 1
SLOTS = 2
BLOCKED = list(range(1, 14)) + [15, 16]
H = 24 * DAYS
_BL = "[" + ", ".join(str(b) for b in BLOCKED) + "]"


def _feas(h: str, d: str, horizon: int = H) -> str:
    return (f"({h} + {d} - 1 <= {horizon - 1} AND NOT list_contains({_BL}, {h}) "
            f"AND NOT list_contains({_BL}, {h} + {d} - 1))")


_CLEAN_SQL = """
cat AS (
  SELECT p_partkey AS key, p_brand AS collection, p_name AS title,
         CAST(p_size * 100 AS BIGINT) AS cost,
         CAST(p_size * 3 AS VARCHAR) || 'XP' AS xp,
         'x' || CAST(p_size * 20 AS VARCHAR) AS units,
         CAST(p_size * 100 AS BIGINT) + CAST(round(p_retailprice * 100) AS BIGINT) % 1000 AS revenue,
         CAST((p_size % 48) AS DOUBLE) / 2.0 AS duration,
         CAST(NULL AS VARCHAR) AS "order"
  FROM part),
clean AS (
  SELECT *, revenue - cost AS benefit, row_number() OVER (ORDER BY key) - 1 AS id,
         CAST(regexp_extract(xp, '(\\d+)', 1) AS BIGINT) AS xp_value
  FROM cat WHERE duration >= 1)"""

_CAND_SQL = f"""
cand AS (
  SELECT c.collection, c.id, CAST(h.range AS INTEGER) AS hour,
         CAST(h.range AS INTEGER) + CAST(ceil(c.duration) AS INTEGER) - 1 AS finish
  FROM clean c, range(0, {H}) h
  WHERE {_feas('CAST(h.range AS INTEGER)', 'CAST(ceil(c.duration) AS INTEGER)')})"""

def _runs_sql(value: str) -> str:
    return f"""
runs0 AS (
  SELECT collection, CAST(ceil(duration) AS INTEGER) AS d, max({value}) AS b
  FROM clean GROUP BY 1, 2),
runs1 AS (
  SELECT r.collection, r.d, r.b, min(c.id) AS id
  FROM runs0 r JOIN clean c
    ON c.collection = r.collection AND CAST(ceil(c.duration) AS INTEGER) = r.d AND c.{value} = r.b
  GROUP BY 1, 2, 3),
menus AS (
  SELECT collection, list({{'d': d, 'b': b, 'id': id}}) AS runs FROM runs1 GROUP BY 1)"""


_RUNS_SQL = _runs_sql("benefit")

def _occ_fold(horizon: int) -> str:
    return f"""CAST({SLOTS} * list_reduce(range({horizon - 1}, -1, -1),
    lambda acc, h: list_prepend(greatest(acc[1], coalesce(list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d', horizon)}), lambda r: r.b + acc[r.d])), acc[1])), acc),
    [0::BIGINT])[1] AS BIGINT)"""


def _feasible(horizon: int) -> str:
    return (f"(len(list_filter(runs, lambda r: len(list_filter(range(0, {horizon}), "
            f"lambda h: {_feas('h', 'r.d', horizon)})) > 0)) > 0)")


_OCC_FOLD, _FEASIBLE = _occ_fold(H), _feasible(H)
SEVERAL_DAYS = 3


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return C.clean_catalog(C.catalog_from_part(part), order_cols=["key"])


@register("catalog_clean", f"""
WITH {_CLEAN_SQL}
SELECT key, collection, title, cost, xp, units, revenue, duration, "order", benefit, id FROM clean""")
def catalog_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).select(
        "key", "collection", "title", "cost", "xp", "units", "revenue", "duration", "order",
        "benefit", "id")


@register("schedule_candidates", f"""
WITH {_CLEAN_SQL}, {_CAND_SQL}
SELECT collection, id, hour, finish, CAST(s.range AS INTEGER) AS slot
FROM cand, range(1, {SLOTS + 1}) s""")
def schedule_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.candidates(_catalog(spark, sf_dir), "collection", SLOTS, DAYS, BLOCKED)


@register("schedule_conflicts", f"""
WITH {_CLEAN_SQL}, {_CAND_SQL}
SELECT a.collection, a.id, a.hour, a.finish, count(*) AS n_conflicts
FROM cand a JOIN cand b ON a.collection = b.collection AND b.hour BETWEEN a.hour AND a.finish
GROUP BY 1, 2, 3, 4""")
def schedule_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.conflict_counts(_catalog(spark, sf_dir), "collection", DAYS, BLOCKED)


@register("schedule_value_occupancy", f"""
WITH {_CLEAN_SQL}, {_RUNS_SQL}
SELECT collection, {SLOTS} AS slots, {_OCC_FOLD} AS value, {_FEASIBLE} AS feasible
FROM menus""")
def schedule_value_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.best_value(_catalog(spark, sf_dir), "collection", SLOTS, DAYS, BLOCKED,
                        mode="occupancy")


@register("schedule_value_days", f"""
WITH {_CLEAN_SQL}, {_RUNS_SQL}
SELECT collection, {SLOTS} AS slots, {_occ_fold(24 * SEVERAL_DAYS)} AS value, {_feasible(24 * SEVERAL_DAYS)} AS feasible
FROM menus""")
def schedule_value_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar of several days; the blocked hours are those of the first."""
    return S.best_value(_catalog(spark, sf_dir), "collection", SLOTS, SEVERAL_DAYS, BLOCKED, mode="occupancy")


@register("schedule_keys", f"""
WITH {_CLEAN_SQL}, {_CAND_SQL},
k AS (SELECT collection, id || '_' || hour || '_' || s.range AS key FROM cand, range(1, {SLOTS + 1}) s)
SELECT collection, key, CAST(split_part(key, '_', 1) AS BIGINT) AS id, CAST(split_part(key, '_', 2) AS BIGINT) AS hour,
       CAST(split_part(key, '_', 3) AS BIGINT) AS slot
FROM k""")
def schedule_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates under their packed key, and the parts read back from it."""
    cand = S.candidates(_catalog(spark, sf_dir), "collection", SLOTS, DAYS, BLOCKED)
    keyed = cand.select("collection", compose_key(F.col("id"), F.col("hour"), F.col("slot")).alias("key"))
    parts = parse_key(F.col("key"), 3, cast="bigint")
    return keyed.select("collection", "key", *(c.alias(n) for c, n in zip(parts, ("id", "hour", "slot"))))


@register("schedule_value_window", f"""
WITH {_CLEAN_SQL}, {_RUNS_SQL},
lb AS (
  SELECT collection, {_FEASIBLE} AS feasible,
    list_transform(range(0, {H}), lambda h: list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d')}), lambda r: r.d))) AS L,
    list_transform(range(0, {H}), lambda h: list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d')}), lambda r: r.b))) AS B
  FROM menus),
lbr AS (
  SELECT *, list_transform(range(0, {H}), lambda h: list_max(list_transform(range(0, h + 1),
        lambda k: k + L[k + 1] - 1))) AS R
  FROM lb)
SELECT collection, {SLOTS} AS slots, CAST({SLOTS} * list_reduce(range({H - 1}, -1, -1),
    lambda acc, h: list_prepend(CASE WHEN L[h + 1] IS NULL THEN acc[1]
        ELSE greatest(acc[1], B[h + 1] + acc[R[h + 1] - h + 1]) END, acc),
    [0::BIGINT])[1] AS BIGINT) AS value, feasible
FROM lbr""")
def schedule_value_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.best_value(_catalog(spark, sf_dir), "collection", SLOTS, DAYS, BLOCKED,
                        mode="window")


@register("schedule_plan", f"""
WITH {_CLEAN_SQL}, {_RUNS_SQL},
choice AS (
  SELECT collection, list_reduce(range({H - 1}, -1, -1),
    lambda acc, h: list_prepend(list_transform([list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d')}),
        lambda r: {{'v': r.b + acc[r.d].v, 'nid': -r.id, 'd': r.d}}))],
      lambda t: CASE WHEN t.v >= acc[1].v
        THEN {{'v': t.v, 'd': t.d, 'id': -t.nid}}
        ELSE {{'v': acc[1].v, 'd': NULL::INTEGER, 'id': NULL::BIGINT}} END)[1], acc),
    [{{'v': 0::BIGINT, 'd': NULL::INTEGER, 'id': NULL::BIGINT}}]) AS ch
  FROM menus),
walk AS (
  SELECT collection, list_reduce(range(0, {H}),
    lambda s, h: CASE
      WHEN h = s.nxt AND ch[h + 1].d IS NOT NULL
        THEN {{'nxt': CAST(h + ch[h + 1].d AS BIGINT),
              'picks': list_append(s.picks, {{'start': CAST(h AS INTEGER), 'd': ch[h + 1].d, 'id': ch[h + 1].id}})}}
      WHEN h = s.nxt THEN {{'nxt': CAST(h + 1 AS BIGINT), 'picks': s.picks}}
      ELSE s END,
    {{'nxt': 0::BIGINT, 'picks': []::STRUCT(start INTEGER, d INTEGER, id BIGINT)[]}}).picks AS picks
  FROM choice),
picks AS (SELECT collection, unnest(picks) AS p FROM walk)
SELECT p.collection, p.p.id AS id, p.p.start AS start, p.p.start + p.p.d - 1 AS finish,
       CAST(s.range AS INTEGER) AS slot, c.title, c.benefit
FROM picks p CROSS JOIN range(1, {SLOTS + 1}) s LEFT JOIN clean c ON c.id = p.p.id""")
def schedule_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _catalog(spark, sf_dir)
    plan = S.best_plan(cat, "collection", SLOTS, DAYS, BLOCKED)
    return plan.join(cat.select("id", "title", "benefit"), "id", "left").select(
        "collection", "id", "start", "finish", "slot", "title", "benefit")


@register("schedule_plan_window", f"""
WITH {_CLEAN_SQL}, {_RUNS_SQL},
longest AS (
  SELECT *, list_transform(range(0, {H}), lambda h: list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d')}), lambda r: r.d))) AS L FROM menus),
reach AS (
  SELECT *, list_transform(range(0, {H}), lambda h: list_max(list_transform(range(0, h + 1), lambda k: k + L[k + 1] - 1))) AS far
  FROM longest),
choice AS (
  SELECT collection, far, list_reduce(range({H - 1}, -1, -1),
    lambda acc, h: list_prepend(list_transform([list_max(list_transform(
        list_filter(runs, lambda r: {_feas('h', 'r.d')}),
        lambda r: {{'v': r.b + acc[far[h + 1] - h + 1].v, 'nid': -r.id, 'd': r.d}}))],
      lambda t: CASE WHEN t.v >= acc[1].v
        THEN {{'v': t.v, 'd': t.d, 'id': -t.nid}}
        ELSE {{'v': acc[1].v, 'd': NULL::INTEGER, 'id': NULL::BIGINT}} END)[1], acc),
    [{{'v': 0::BIGINT, 'd': NULL::INTEGER, 'id': NULL::BIGINT}}]) AS ch
  FROM reach),
walk AS (
  SELECT collection, list_reduce(range(0, {H}),
    lambda s, h: CASE
      WHEN h = s.nxt AND ch[h + 1].d IS NOT NULL
        THEN {{'nxt': CAST(far[h + 1] + 1 AS BIGINT),
              'picks': list_append(s.picks, {{'start': CAST(h AS INTEGER), 'd': ch[h + 1].d, 'id': ch[h + 1].id}})}}
      WHEN h = s.nxt THEN {{'nxt': CAST(h + 1 AS BIGINT), 'picks': s.picks}}
      ELSE s END,
    {{'nxt': 0::BIGINT, 'picks': []::STRUCT(start INTEGER, d INTEGER, id BIGINT)[]}}).picks AS picks
  FROM choice),
picks AS (SELECT collection, unnest(picks) AS p FROM walk)
SELECT p.collection, p.p.id AS id, p.p.start AS start, p.p.start + p.p.d - 1 AS finish,
       CAST(s.range AS INTEGER) AS slot, c.title, c.benefit
FROM picks p CROSS JOIN range(1, {SLOTS + 1}) s LEFT JOIN clean c ON c.id = p.p.id""")
def schedule_plan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs behind ``schedule_value_window``."""
    cat = _catalog(spark, sf_dir)
    plan = S.best_plan(cat, "collection", SLOTS, DAYS, BLOCKED, mode="window")
    return plan.join(cat.select("id", "title", "benefit"), "id", "left").select(
        "collection", "id", "start", "finish", "slot", "title", "benefit")


@register("schedule_value_xp", f"""
WITH {_CLEAN_SQL}, {_runs_sql('xp_value')}
SELECT collection, {SLOTS} AS slots, {_OCC_FOLD} AS value, {_FEASIBLE} AS feasible
FROM menus""")
def schedule_value_xp(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _catalog(spark, sf_dir).withColumn("xp_value", C.numeric_suffix("xp").cast("bigint"))
    return S.best_value(cat, "collection", SLOTS, DAYS, BLOCKED, mode="occupancy", value_col="xp_value")
