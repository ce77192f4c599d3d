"""Registered queries of the operators: thin digests of what each operator returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bpe,
    embeddings,
    language,
    line_dedup,
    lm_scoring,
    manifest,
    near_dedup,
    packing,
    periodic_runs,
    pii,
    quality,
    token_files,
    toxicity,
)
from tessera.llm.common import read_documents, scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return pii.digest(pii.find(docs, pii.train(docs)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_documents(spark, sf_dir), BYTE_BPE)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


def op4_bit_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    token_files.write_token_files(read_documents(spark, sf_dir), path, WORD_BPE)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_projection_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def op6_output_codes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = language.train(docs, lambda i: _crc_mod(i, 3) == 1)
    return language.identify(docs, model).select(
        "doc_id", F.coalesce(_crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "ambiguous")


def op7_weighted_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_documents(spark, sf_dir))


def op8_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(read_documents(spark, sf_dir), MULTI_BPE, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, MULTI_BPE, public_tokenizers.PATTERN)
    return decoded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(read_documents(spark, sf_dir)).drop("cleaned")


def op9_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_documents(spark, sf_dir)).select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_removed").cast("bigint").alias("n_removed"), F.md5(F.coalesce("deduped", F.lit(""))).alias("text_md5"))


def _crc_mod(id_col, n: int):
    return F.crc32(id_col.cast("string").cast("binary")) % n


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    """Learned only from rows whose crc32 of the id is not divisible by five."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.train(docs, labels, lambda i: _crc_mod(i, 5) == 0)


def op10_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(_crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_link_cut_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth text (by the checksum of its id) first has its tail replaced by repeats."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(h % 10 == 0, periodic_runs.repeat_tail(F.col("text"), h)).otherwise(F.col("text"))
    return periodic_runs.digest(periodic_runs.find_runs(read_documents(spark, sf_dir).select("doc_id", text.alias("text"))))


def op12_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_documents(spark, sf_dir), _crc_mod(F.col("doc_id"), 7) == 2)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read_documents(spark, sf_dir), _crc_mod(F.col("doc_id"), 3) == 0)


QUERIES = {f.__name__: f for f in (
    op1_boosted_pii, op2_best_fit_packing, op3_line_first_cleaning, op4_bit_plane_files, op5_projection_forest_dedup,
    op6_output_codes_language, op7_weighted_minhash_dedup, op8_segment_tree_bpe, op9_winnowed_line_dedup,
    op10_levenshtein_toxicity, op11_link_cut_runs,
    op12_backoff_automaton, op13_merkle_manifest)}
ORACLE_SQL = {"op3_line_first_cleaning": quality.oracle_sql(), "op5_projection_forest_dedup": embeddings.oracle_sql(),
              "op9_winnowed_line_dedup": line_dedup.oracle_sql(), "op13_merkle_manifest": manifest.oracle_sql()}
