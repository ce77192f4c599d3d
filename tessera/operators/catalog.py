"""Catalog cleaning: raw product listing -> typed catalog with benefit and dense id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.indexing import dense_index

# Renames applied after lower-casing the raw header names.
CATALOG_RENAMES = {
    "total revenue (coins)": "revenue",
    "time (hrs)": "duration",
    "price (coins)": "cost",
    "experience (xp)": "xp",
}


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def clean_catalog(raw: DataFrame, order_cols: list[str] | None = None,
                  min_duration: float = 1.0) -> DataFrame:
    """Lower-case names, rename, ``benefit = revenue - cost``, keep ``duration >= 1``,
    number the rows densely from 0 in ``order_cols`` order (input order key)."""
    df = lower_columns(raw).withColumnsRenamed(CATALOG_RENAMES)
    df = df.withColumn("benefit", F.col("revenue") - F.col("cost"))
    df = df.where(F.col("duration") >= min_duration)
    return dense_index(df, order_cols or ["title"], "id")


def numeric_suffix(col: str, pattern: str = r"(\d+)") -> F.Column:
    """Numeric part of tokens like ``99XP`` or ``x620`` (kept raw by the cleaner)."""
    return F.regexp_extract(F.col(col), pattern, 1).cast("int")


def catalog_from_part(part: DataFrame) -> DataFrame:
    """Raw listing layout built from ``part`` by fixed arithmetic rules.

    collection = brand, cost = 100 x size coins, revenue = cost + (retail cents mod 1000),
    duration = (size mod 48) / 2 hours (half hours, some below one hour).
    """
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cost = (F.col("p_size") * 100).cast("bigint")
    return part.select(
        F.col("p_partkey").alias("Key"),
        F.col("p_brand").alias("Collection"),
        F.col("p_name").alias("Title"),
        cost.alias("Price (Coins)"),
        F.concat((F.col("p_size") * 3).cast("string"), F.lit("XP")).alias("Experience (XP)"),
        F.concat(F.lit("x"), (F.col("p_size") * 20).cast("string")).alias("Units"),
        (cost + cents % 1000).alias("Total Revenue (Coins)"),
        ((F.col("p_size") % 48) / 2.0).alias("Time (Hrs)"),
        F.lit(None).cast("string").alias("Order"),
    )
