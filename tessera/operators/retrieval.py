"""Two-stage retrieval: exact top-k first stage, rescoring second stage, context text.

First stage: BM25 over a postings table (``postings``) or cosine over a cell index (``cells``);
both are exact, take the queries as a table and hold none of them on the driver.  Second stage: any
scorer of two token arrays (Jaccard overlap by default) on the ``k`` candidates only, keep ``n``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators import cells, postings
from tessera.operators.postings import BM25_B, BM25_K1, SCORE_DECIMALS, TOKEN, tokens  # noqa: F401
from tessera.session import cut_lineage

# Prompt template and the separator between context passages.
PROMPT_TEMPLATE = ("Use the following context to answer the question.\n\n"
                   "Context:\n{context}\n\nQuestion: {question}\n<think>\n")
CONTEXT_SEPARATOR = "\n\n"


def bm25_top_k(queries: DataFrame, corpus: DataFrame, qid_col: str, qtext_col: str,
               keys: Sequence[str], text_col: str, k: int = 10) -> DataFrame:
    """Top-``k`` corpus rows per query by BM25: ``(qid, *keys, score, rank)``.

    Only rows sharing at least one token with the query are candidates.  To ask several query tables,
    build the index once (``postings.build``) and call ``postings.search``."""
    # queries x k rows: written once so later joins do not search again.
    return cut_lineage(postings.search(postings.build(corpus, keys, text_col), queries, qid_col, qtext_col, k)[0])


def cosine_top_k(queries: DataFrame, corpus: DataFrame, qid_col: str, qvec_col: str,
                 keys: Sequence[str], vec_col: str, k: int = 10) -> DataFrame:
    """Exact top-``k`` by cosine similarity: ``(qid, *keys, score, rank)``."""
    return cut_lineage(cells.exact(cells.build(corpus, keys, vec_col), queries, qid_col, qvec_col, k)[0])


# --- second stage, context, answers ---------------------------------------------------

def jaccard(a: Column, b: Column) -> Column:
    a, b = F.array_distinct(a), F.array_distinct(b)
    return (F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).cast("double")


def coverage(a: Column, b: Column) -> Column:
    """Share of the first text's distinct tokens that the second holds."""
    a = F.array_distinct(a)
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(0.0)).cast("double")


def rerank(candidates: DataFrame, queries: DataFrame, corpus: DataFrame, qid_col: str,
           qtext_col: str, keys: Sequence[str], text_col: str, n: int = 3,
           scorer: Callable[[Column, Column], Column] = jaccard) -> DataFrame:
    """Rescore the first-stage candidates by ``scorer(query tokens, passage tokens)`` and keep
    the best ``n``.

    Output ``(qid, *keys, stage1_rank, stage1_score, score, rank)``; ties keep the
    first-stage order.  Give a ``corpus`` cut down to the candidates' documents where the
    passages are made on the fly; whether candidates are broadcast is left to the size check
    of adaptive execution.
    """
    keys = list(keys)
    cand = candidates.select(qid_col, *keys, F.col("rank").alias("stage1_rank"),
                             F.col("score").alias("stage1_score"))
    texts = corpus.select(*keys, F.col(text_col).alias("_ctext")).join(cand, keys)
    q = queries.select(F.col(qid_col), tokens(F.col(qtext_col)).alias("_qt"))
    scored = texts.join(q, qid_col).withColumn(
        "score", scorer(F.col("_qt"), tokens(F.col("_ctext"))))
    w = Window.partitionBy(qid_col).orderBy(F.col("score").desc(), F.col("stage1_rank").asc())
    return cut_lineage(
        scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
        .select(qid_col, *keys, "stage1_rank", "stage1_score", "score", "rank")
    )


def assemble_context(kept: DataFrame, corpus: DataFrame, queries: DataFrame, qid_col: str,
                     qtext_col: str, keys: Sequence[str], text_col: str) -> DataFrame:
    """Per query: passages joined in rank order and the filled prompt.

    ``(qid, n_passages, context, prompt)``; one group holds at most ``n`` passages.
    """
    keys = list(keys)
    texts = corpus.select(*keys, F.col(text_col).alias("_t")).join(kept.select(qid_col, *keys, "rank"), keys)
    ctx = texts.groupBy(qid_col).agg(
        F.count(F.lit(1)).alias("n_passages"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "_t"))), lambda x: x["_t"]),
                     CONTEXT_SEPARATOR).alias("context"))
    q = queries.select(qid_col, F.col(qtext_col).alias("_q"))
    head, rest = PROMPT_TEMPLATE.split("{context}")
    mid, tail = rest.split("{question}")
    return ctx.join(q, qid_col).select(
        qid_col, "n_passages", "context",
        F.concat(F.lit(head), F.col("context"), F.lit(mid), F.col("_q"), F.lit(tail)).alias("prompt"))


# --- approximate first stage and text vectors -----------------------------------------

def lsh_top_k(queries: DataFrame, corpus: DataFrame, qid_col: str, qvec_col: str, key_col: str,
              vec_col: str, k: int = 10, bucket_length: float = 1.0, tables: int = 4,
              seed: int = 7) -> DataFrame:
    """Approximate top-``k`` by Euclidean distance of L2-normalised vectors (same order as
    cosine) with random-projection LSH: only pairs sharing a hash bucket are compared
    (an equi-join on bucket ids, no cartesian product).  ``(qid, key, distance, rank)``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector

    def prep(df: DataFrame, id_col: str, v: str, out_id: str) -> DataFrame:
        vec = df.select(F.col(id_col).alias(out_id), array_to_vector(F.col(v).cast("array<double>")).alias("_raw"))
        return Normalizer(inputCol="_raw", outputCol="features", p=2.0).transform(vec).select(out_id, "features")

    q = prep(queries, qid_col, qvec_col, "qid")
    c = prep(corpus, key_col, vec_col, "key")
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=tables, seed=seed).fit(c)
    pairs = model.approxSimilarityJoin(q, c, 2.0, distCol="distance") \
        .select(F.col("datasetA.qid").alias(qid_col), F.col("datasetB.key").alias(key_col), "distance")
    w = Window.partitionBy(qid_col).orderBy("distance", key_col)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall_at_k(approx: DataFrame, exact: DataFrame, qid_col: str, key_col: str, k: int) -> DataFrame:
    """Share of the exact top-k found by the approximate top-k, per query."""
    hits = exact.select(qid_col, key_col).join(approx.select(qid_col, key_col), [qid_col, key_col], "left_semi")
    per = hits.groupBy(qid_col).agg(F.count(F.lit(1)).alias("hits"))
    found = approx.groupBy(qid_col).agg(F.count(F.lit(1)).alias("n_found"))
    return exact.select(qid_col).distinct().join(per, qid_col, "left").join(found, qid_col, "left").select(
        qid_col, F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("n_found", F.lit(0)).alias("n_found"),
        (F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("recall_at_k"))
