"""A corpus pipeline over ``documents``: toxicity, line dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on every row that its
predecessor kept, and its result is written and read back for the next one.  All but the last
return the columns of ``documents`` (and any further columns of their input) unchanged but for
the text and its length.  Null and empty texts pass through every stage as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, near_dedup, packing, pii, toxicity
from tessera.llm.common import read_documents, write_table
from tessera.llm.queries import BYTE_BPE, toxicity_model

#: Documents scoring at least this are rejected.
TOXIC = 0.5


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """``columns`` with a new text, and its length where there is a column for it."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return docs.select(*(F.when(F.col("text").isNull(), F.col(c)).otherwise(new[c]).alias(c) if c in new else F.col(c)
                         for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; the model is fitted on labelled rows of docs."""
    name = _unused(docs, "toxicity")
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir), score_col=name).where(F.col(name) < TOXIC).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out; a document all of whose lines go, goes itself."""
    cut = line_dedup.cut_runs(docs)
    text = _unused(docs, "deduped")
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))).select(
        "row.*", F.col("deduped").alias(text))
    return _with_text(kept, F.col(text), docs.columns)


def drop_whole_copies(docs: DataFrame) -> DataFrame:
    """Of the documents of one text the one with the least id stays, and rows with a null id; texts
    without a word stay as they are."""
    k1, k2, first = (_unused(docs, n) for n in ("copy_k1", "copy_k2", "first_id"))
    keyed = docs.select("*", F.xxhash64("text").alias(k1), F.xxhash64(F.lit(1), "text").alias(k2))
    firsts = write_table(keyed.where(F.col("text").rlike(r"\S")).groupBy(k1, k2)
                         .agg(F.min("doc_id").alias(first), F.count(F.lit(1)).alias("n")).where("n > 1").select(k1, k2, first))
    later = F.col("doc_id") > F.col(first)
    return keyed.join(firsts.hint("merge"), [k1, k2], "left").where(~F.coalesce(later, F.lit(False))).select(
        *(keyed[c] for c in docs.columns))


def drop_copies_and_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies go before lines are cut: behind its last full window a copy keeps lines, and
    what is left of it no longer resembles its original."""
    return drop_repeated_lines(spark, write_table(drop_whole_copies(docs), compression="zstd"), sf_dir)


def texts_before_cutting(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and text in ``documents`` of the rows of ``docs`` whose text differs from it by now.

    Ids are matched with hashes of the texts, and texts are read for the ids that changed only."""
    source = read_documents(spark, sf_dir).select("doc_id", "text")
    now = docs.select("doc_id", F.xxhash64("text").alias("now"))
    then = source.select("doc_id", F.xxhash64("text").alias("then"))
    changed = write_table(now.join(then.hint("merge"), "doc_id").where("now <> then").select("doc_id").distinct())
    return write_table(source.join(changed, "doc_id", "left_semi"), compression="zstd")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id (rows of one
    id are one document, and stay or go together).

    Texts are compared as they are and, where earlier stages cut lines out, as they were in
    ``documents`` too: what the line stage leaves of a near copy need not resemble its original."""
    gone = _unused(docs, "gone")
    before = texts_before_cutting(spark, docs, sf_dir)
    texts = docs.select("doc_id", "text").unionByName(before)
    copies = near_dedup.near_duplicates(texts).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(write_table(copies).hint("merge"), F.col("doc_id") == F.col(gone), "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    names = tuple(_unused(docs, n) for n in pii.OUT)
    return _with_text(pii.find(docs, pii.train(docs), names=names), F.col(names[2]), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs, BYTE_BPE).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_copies_and_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

#: Learned stages can't be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as a table and read back."""
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
