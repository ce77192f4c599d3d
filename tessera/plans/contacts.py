"""Contact-number queries over phone numbers written in ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import contacts as T
from tessera.plans.registry import register
from tessera.sources import read_table

KEEP_HEAD = 5
KEEP_TAIL = 2

_NUMS_SQL = f"""
nums0 AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS raw
  FROM (SELECT doc_id, regexp_extract_all(text, '({T.PHONE_PATTERN})', 1) AS l FROM documents)),
nums AS (SELECT *, '+' || regexp_replace(raw, '\\D', '', 'g') AS number FROM nums0),
masked AS (
  SELECT DISTINCT substring(number, 1, {KEEP_HEAD})
    || regexp_replace(substring(number, {KEEP_HEAD + 1}, greatest(length(number) - {KEEP_HEAD + KEEP_TAIL}, 0)), '\\d', '*', 'g')
    || substring(number, greatest(length(number) - {KEEP_TAIL - 1}, {KEEP_HEAD + 1}), {KEEP_TAIL}) AS mask
  FROM nums),
mk AS (SELECT mask, length(mask) - length(replace(mask, '*', '')) AS k FROM masked),
fills AS (
  SELECT mask, unnest(CASE WHEN k = 0 THEN [[]::INTEGER[]] ELSE list_reduce(range(1, k + 1),
      lambda acc, i: flatten(list_transform(acc, lambda a: list_transform(range(coalesce(a[-1], 0), 10),
                                                                          lambda d: list_append(a, CAST(d AS INTEGER))))),
      [[]::INTEGER[]]) END) AS digits
  FROM mk),
cands AS (
  SELECT mask, list_reduce(digits, lambda s, d: split_part(s, '*', 1) || CAST(d AS VARCHAR) || substr(s, strpos(s, '*') + 1),
                           mask) AS candidate
  FROM fills)"""

# Written on its own, not from the operator's patterns.
_READ_SQL = """
loose AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS raw
  FROM (SELECT doc_id, regexp_extract_all(text, '[+][0-9][-0-9 ().]{5,}[0-9]') AS l FROM documents)),
parts AS (
  SELECT *, '+' || regexp_replace(raw, '[^0-9]', '', 'g') AS number,
         regexp_extract(raw, '^[+][0-9]+ [(]([0-9][0-9][0-9])[)]', 1) AS area,
         regexp_replace(regexp_extract(raw, '^[+][0-9]+ (.*)$', 1), '[^0-9]', '', 'g') AS rest FROM loose),
read AS (
  SELECT *, CASE WHEN area = '' THEN 'no area code' WHEN length(rest) <> 10 THEN 'not ten national digits'
                 WHEN left(area, 1) IN ('0', '1') THEN 'area code out of range' END AS cause FROM parts)"""


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return T.extract_numbers(docs)


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select(T.mask_number(F.col("number"), KEEP_HEAD, KEEP_TAIL).alias("mask")).distinct()


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.expand_masks(_masks(spark, sf_dir))


def _read(spark: SparkSession, sf_dir: str):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return T.classify_numbers(T.extract_numbers(docs, pattern=T.LOOSE_PATTERN))


@register("mask_expand", f"""
WITH {_NUMS_SQL}
SELECT mask, candidate FROM cands""")
def mask_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


@register("mask_known", f"""
WITH {_NUMS_SQL}
SELECT mask, candidate FROM cands WHERE candidate IN (SELECT number FROM nums)""")
def mask_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.known_fillings(_masks(spark, sf_dir), _numbers(spark, sf_dir), KEEP_HEAD, KEEP_TAIL)


@register("mask_summary", f"""
WITH {_NUMS_SQL},
known AS (SELECT DISTINCT number FROM nums)
SELECT mask, count(*) AS n_candidates,
       CAST(sum(CASE WHEN k.number IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_known
FROM cands LEFT JOIN known k ON k.number = cands.candidate GROUP BY mask""")
def mask_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates are counted by formula, known ones by a join on the mask: nothing is expanded."""
    masks = _masks(spark, sf_dir)
    known = T.known_fillings(masks, _numbers(spark, sf_dir), KEEP_HEAD, KEEP_TAIL).groupBy("mask").agg(
        F.count(F.lit(1)).alias("n_known"))
    return masks.join(known, "mask", "left").select(
        "mask", T.filling_count(T.star_count(F.col("mask"))).alias("n_candidates"),
        F.coalesce("n_known", F.lit(0)).cast("bigint").alias("n_known"))


@register("phone_normalise", f"""
WITH {_READ_SQL}
SELECT doc_id, pos, number AS international_number, regexp_extract(raw, '^\\+([0-9]+)', 1) AS international_calling_code,
       area AS prefix_network, true AS is_valid, CAST(NULL AS INTEGER) AS error_code
FROM read WHERE cause IS NULL""")
def phone_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir)[0]


@register("phone_errors", f"""
WITH {_READ_SQL}
SELECT doc_id, pos, number AS international_number, raw AS message,
       CASE WHEN cause LIKE 'area%' THEN 9 ELSE 2 END AS error_code, cause
FROM read WHERE cause IS NOT NULL""")
def phone_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir)[1]


_CODES_SQL = "(VALUES " + ", ".join(f"({i}, '{d}')" for i, d in T.ERROR_CODES) + ") AS codes(id, description)"


@register("phone_upsert", f"""
WITH {_READ_SQL},
latest AS (SELECT *, CASE WHEN cause IS NULL THEN NULL WHEN cause LIKE 'area%' THEN 9 ELSE 2 END AS code
           FROM read QUALIFY row_number() OVER (PARTITION BY number ORDER BY doc_id DESC, pos DESC) = 1)
SELECT l.number AS international_number, l.doc_id, l.pos, l.cause IS NULL AS is_valid,
       CASE WHEN codes.id IS NOT NULL THEN l.code END AS error_code, codes.description AS error_description
FROM latest l LEFT JOIN {_CODES_SQL} ON l.code = codes.id""")
def phone_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row of every number, valid or not; codes that the lookup lacks become null."""
    return _latest(spark, *_read(spark, sf_dir))


def _latest(spark: SparkSession, info: DataFrame, errors: DataFrame) -> DataFrame:
    columns = ["doc_id", "pos", "international_number", "is_valid", "error_code"]
    rows = info.select(columns).unionByName(errors.withColumn("is_valid", F.lit(False)).select(columns))
    latest = T.upsert_latest(rows, ["international_number"], ["doc_id", "pos"])
    codes = spark.createDataFrame(T.ERROR_CODES, "id INT, description STRING")
    return T.resolve_error_codes(latest, codes)


#: Numbers with or without an international prefix; those without one are errors of a known code.
ANY_NUMBER = r"\+?[0-9][0-9 ().-]{7,}[0-9]"


@register("phone_code_lookup", f"""
WITH {_READ_SQL.replace("[+][0-9][-0-9 ().]{5,}[0-9]", "[+]?[0-9][-0-9 ().]{7,}[0-9]")},
latest AS (SELECT *, CASE WHEN cause IS NULL THEN NULL WHEN cause LIKE 'area%' THEN 9 ELSE 2 END AS code
           FROM read QUALIFY row_number() OVER (PARTITION BY number ORDER BY doc_id DESC, pos DESC) = 1)
SELECT l.number AS international_number, l.doc_id, l.pos, l.cause IS NULL AS is_valid,
       CASE WHEN codes.id IS NOT NULL THEN l.code END AS error_code, codes.description AS error_description
FROM latest l LEFT JOIN {_CODES_SQL} ON l.code = codes.id""")
def phone_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``phone_upsert``, over numbers written in any way: most error codes resolve."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return _latest(spark, *T.classify_numbers(T.extract_numbers(docs, pattern=ANY_NUMBER)))


@register("mask_unknown", f"""
WITH {_NUMS_SQL}
SELECT mask, candidate FROM cands WHERE candidate NOT IN (SELECT number FROM nums)""")
def mask_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates not yet known (to be enriched)."""
    return T.unknown_fillings(_masks(spark, sf_dir), _numbers(spark, sf_dir), KEEP_HEAD, KEEP_TAIL)
