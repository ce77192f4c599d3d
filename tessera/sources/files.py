"""CSV sources and sinks with explicit schemas (no schema inference at scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw catalog layout: header names as written in the file.
CATALOG_CSV_SCHEMA = T.StructType([
    T.StructField("Collection", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Price (Coins)", T.LongType()),
    T.StructField("Experience (XP)", T.StringType()),
    T.StructField("Units", T.StringType()),
    T.StructField("Total Revenue (Coins)", T.LongType()),
    T.StructField("Time (Hrs)", T.DoubleType()),
    T.StructField("Order", T.StringType()),
])

# Offer menu: quantity and money with two decimals kept exact.
OFFER_CSV_SCHEMA = T.StructType([
    T.StructField("amount", T.IntegerType()),
    T.StructField("price", T.DecimalType(10, 2)),
])

# Evaluation scores written by SNK1 and read back by SRC3.
EVAL_SCORE_SCHEMA = T.StructType([
    T.StructField("user_input", T.StringType()),
    T.StructField("faithfulness", T.DoubleType()),
    T.StructField("answer_relevancy", T.DoubleType()),
    T.StructField("nv_context_relevance", T.DoubleType()),
])


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG_CSV_SCHEMA).option("header", True).csv(path)


def read_offer_csv(spark: SparkSession, path: str, group_id: int = 0) -> DataFrame:
    """Offer menu ``(group_id, amount, price_cents)``; money becomes integer cents."""
    df = spark.read.schema(OFFER_CSV_SCHEMA).option("header", True).csv(path)
    return df.select(
        F.lit(group_id).cast("bigint").alias("group_id"),
        F.col("amount"),
        (F.col("price") * 100).cast("bigint").alias("price_cents"),
    )


def write_scores_csv(df: DataFrame, path: str) -> None:
    """Header CSV, no index column; overwrite keeps reruns idempotent after failures."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_scores_csv(spark: SparkSession, path: str, schema: T.StructType = EVAL_SCORE_SCHEMA) -> DataFrame:
    """Quotes inside a field are doubled, as common writers do (not escaped by a backslash)."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
