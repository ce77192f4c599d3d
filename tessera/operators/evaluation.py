"""Retrieval evaluation without a judge model, and the summaries behind a score report.

* ``label_retrieval_scores``: precision@k, recall@k and reciprocal rank of the first
  hit for queries whose relevant set is "rows with the same label".
* ``support_scores``: per question, model-free scores of the kept passages: share of the
  question's tokens found in the context, overlap of the best passage, mean overlap.
* ``score_summary`` / ``score_grid`` / ``score_extremes``: per-metric mean/min/max, the
  question x metric grid with bands and cell text colour, and the lowest/highest pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import truncate_ellipsis
from tessera.operators.indexing import dense_index


# Metric names, the rule-of-thumb bands and the cell text-colour rule.
METRICS = ["faithfulness", "answer_relevancy", "nv_context_relevance"]
GOOD_ABOVE = 0.7
WEAK_BELOW = 0.5
WHITE_BELOW = 0.3
WHITE_ABOVE = 0.85
QUESTION_CHARS = 65


def label_retrieval_scores(neighbours: DataFrame, labels: DataFrame, qid_col: str,
                           key_col: str, label_col: str, k: int) -> DataFrame:
    """``neighbours(qid, key, rank)`` where the query id is itself a label value.

    Output ``(qid, hits, precision_at_k, recall_at_k, mrr)``; recall divides by the
    label's population (a grouped count, partial-aggregated).
    """
    lab = labels.select(F.col(key_col), F.col(label_col).alias("_lab"))
    pop = labels.groupBy(F.col(label_col).alias(qid_col)).agg(F.count(F.lit(1)).alias("_pop"))
    hit = (F.col("_lab") == F.col(qid_col))
    per_q = (
        lab.join(neighbours.select(qid_col, key_col, "rank"), key_col)
        .groupBy(qid_col)
        .agg(F.sum(hit.cast("int")).cast("bigint").alias("hits"),
             F.min(F.when(hit, F.col("rank"))).alias("_first"))
    )
    return per_q.join(pop, qid_col).select(
        qid_col, "hits",
        (F.col("hits") / F.lit(float(k))).alias("precision_at_k"),
        (F.col("hits") / F.col("_pop")).alias("recall_at_k"),
        F.coalesce(1.0 / F.col("_first"), F.lit(0.0)).alias("mrr"),
    )


def band(score: Column) -> Column:
    return (F.when(score.isNull(), F.lit(None))
            .when(score > GOOD_ABOVE, F.lit("acceptable"))
            .when(score < WEAK_BELOW, F.lit("problem"))
            .otherwise(F.lit("borderline")))


def text_colour(score: Column) -> Column:
    clipped = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    return F.when((clipped < WHITE_BELOW) | (clipped > WHITE_ABOVE), F.lit("white")).otherwise(F.lit("black"))


def long_scores(scores: DataFrame, id_cols: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """Wide question x metric frame to ``(*ids, metric, score)`` (``unpivot``)."""
    return scores.unpivot(list(id_cols), list(metrics), "metric", "score")


def score_summary(scores: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Per metric: count, mean, min, max."""
    lng = long_scores(scores, [], metrics)
    return lng.groupBy("metric").agg(
        F.count("score").alias("n"), F.avg("score").alias("mean"),
        F.min("score").alias("min"), F.max("score").alias("max"))


def label_questions(scores: DataFrame, order_col: str, text_col: str) -> DataFrame:
    """``Q1..Qn`` labels in ``order_col`` order and the question cut to 65 chars + ellipsis."""
    indexed = dense_index(scores, [order_col], "_i", start=1)
    return indexed.withColumn("q", F.concat(F.lit("Q"), F.col("_i").cast("string"))) \
        .withColumn("question", truncate_ellipsis(F.col(text_col), QUESTION_CHARS)).drop("_i")


def score_grid(labelled: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """``(q, question, metric, score, band, text_colour)``."""
    lng = long_scores(labelled.select("q", "question", *metrics), ["q", "question"], metrics)
    return lng.select("q", "question", "metric", "score",
                      band(F.col("score")).alias("band"),
                      text_colour(F.col("score")).alias("text_colour"))


def score_extremes(labelled: DataFrame, n: int = 3, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The ``n`` lowest and ``n`` highest (question, metric) pairs; ties by (q, metric).

    A top-n per direction is a bounded window limit (``WindowGroupLimit``), not a sort
    of everything into one task.
    """
    lng = long_scores(labelled.select("q", *metrics), ["q"], metrics).where(F.col("score").isNotNull())
    lo = Window.orderBy(F.col("score").asc(), "q", "metric")
    hi = Window.orderBy(F.col("score").desc(), "q", "metric")
    low = lng.withColumn("pos", F.row_number().over(lo)).where(F.col("pos") <= n) \
        .withColumn("kind", F.lit("lowest"))
    high = lng.withColumn("pos", F.row_number().over(hi)).where(F.col("pos") <= n) \
        .withColumn("kind", F.lit("highest"))
    return low.unionByName(high).select("kind", "pos", "q", "metric", "score")


def first_sentence(text: Column) -> Column:
    return F.trim(F.regexp_extract(text, r"(?s)^([^.!?]*[.!?]?)", 1))


def eval_rows(kept: DataFrame, candidates: DataFrame, corpus: DataFrame, queries: DataFrame, qid_col: str,
              qtext_col: str, keys: Sequence[str], text_col: str) -> DataFrame:
    """One row per question: ``(qid, user_input, response, retrieved_contexts)``.

    The response is extractive: the first sentence of the best first-stage passage.  The
    contexts are the kept passages in rank order, an array of at most ``n`` texts."""
    keys = list(keys)
    texts = corpus.select(*keys, F.col(text_col).alias("_t"))
    contexts = texts.join(kept.select(qid_col, *keys, "rank"), keys).groupBy(qid_col).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "_t"))), lambda x: x["_t"]).alias("retrieved_contexts"))
    answers = texts.join(candidates.where(F.col("rank") == 1).select(qid_col, *keys), keys).select(
        qid_col, first_sentence(F.col("_t")).alias("response"))
    return (queries.select(qid_col, F.col(qtext_col).alias("user_input")).join(answers, qid_col).join(contexts, qid_col)
            .select(qid_col, "user_input", "response", "retrieved_contexts"))


def support_scores(rows: DataFrame, kept: DataFrame, qid_col: str) -> DataFrame:
    """Scores of evaluation rows without a judge model: ``(qid, user_input, faithfulness,
    answer_relevancy, nv_context_relevance)``.

    Faithfulness is the share of the response's distinct tokens found in the contexts, answer
    relevancy the token overlap of response and question, context relevance the mean
    second-stage score of the kept passages (at most ``n`` rows per question)."""
    from tessera.operators.retrieval import coverage, jaccard, tokens

    mean = kept.groupBy(qid_col).agg(F.avg("score").alias("nv_context_relevance"))
    answer, question = tokens(F.col("response")), tokens(F.col("user_input"))
    context = tokens(F.array_join("retrieved_contexts", "\n\n"))
    return rows.join(mean, qid_col).select(
        qid_col, "user_input", coverage(answer, context).alias("faithfulness"),
        jaccard(answer, question).alias("answer_relevancy"), "nv_context_relevance")
