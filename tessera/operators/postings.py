"""First-stage text retrieval over a postings table, for any number of queries in one plan.

Index.  One pass over the corpus cuts it into blocks of at most ``BLOCK_ROWS`` rows and writes one
record for every block and term (row numbers, counts, row lengths) and one for every block (its
rows' keys).  The text is not read again, whatever is asked.

Search.  Queries are a table of (query, term).  The score is BM25; the k best rows of a query are
found exactly without scoring every row:

1. Postings of the queries' terms get their weights, and every (term, block) its largest weight.
2. A query meets the blocks that hold any of its terms; the sum of its terms' largest weights there
   bounds what a row of the block can score.
3. The block of the greatest bound is scored first; its k-th best score is the least that a further
   block's bound must reach to be scored as well.
4. A task scores one block for many queries with array operations and keeps ``k`` rows a query.

Nothing is collected but the number of rows and tokens.  Joins are on term, block and query, so hot
terms are skewed keys that adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tessera.operators.parallelism import spread
from tessera.session import cut_lineage, ship_package

# Word token = run of characters that are not whitespace or punctuation.
TOKEN = r'[^ \t\n\r\f.,;:!?()\[\]{}<>"]+'
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DECIMALS = 9
BLOCK_ROWS = 1024
#: Queries that one task scores against a block, about.
QUERIES = 4096
#: Sums of weights closer than this are not told apart by a bound.
SLACK = 1e-6
FEATURES = 1 << 18


def _counter():
    return count().__next__


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), 0)


@dataclass
class PostingIndex:
    """``table``: block, term, rows, tfs, dls and (for the empty term) the rows' keys."""

    table: DataFrame
    keys: list[str]
    n_rows: int
    mean_length: float


def build(corpus: DataFrame, keys: Sequence[str], text_col: str, block_rows: int = BLOCK_ROWS) -> PostingIndex:
    keys = list(keys)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("term", T.StringType()), T.StructField("rows", ints),
                           T.StructField("tfs", ints), T.StructField("dls", ints),
                           *(T.StructField(f"key_{i}", T.ArrayType(corpus.schema[c].dataType)) for i, c in enumerate(keys))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, block = re.compile(TOKEN).findall, TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                found = [find(t.lower()) if t else [] for t in part.column(len(keys)).to_pylist()]
                lengths = np.array([len(f) for f in found], np.int64)
                number: dict[str, int] = defaultdict(_counter())
                ids = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64, int(lengths.sum()))
                # Sorted by term and then row, so each term's postings stand together.
                pair, tf = np.unique(ids * len(found) + np.repeat(np.arange(len(found)), lengths), return_counts=True)
                term, row = pair // max(len(found), 1), pair % max(len(found), 1)
                ends = np.searchsorted(term, np.arange(len(number)), side="right")
                offsets = np.concatenate([[0], ends, [len(pair) + len(found)]])  # the last record is the block's own
                everyone = np.arange(len(found))

                def lists(own: np.ndarray, last: np.ndarray, offsets=offsets) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([own, last]), pa.int32()))

                columns = [pa.array(np.full(len(number) + 1, block), pa.int64()), pa.array([*number, ""], pa.string()),
                           lists(row, everyone), lists(tf, np.zeros(len(found))), lists(lengths[row], lengths)]
                empty = pa.array(np.concatenate([np.zeros(len(number) + 1), [len(found)]]), pa.int32())
                columns += [pa.ListArray.from_arrays(empty, part.column(i)) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])
                block += 1

    ship_package(corpus.sparkSession)
    table = cut_lineage(spread(corpus.select(*keys, F.col(text_col).alias("text"))).mapInArrow(run, schema))
    size = table.where("term = ''").agg(
        F.sum(F.size("rows")).alias("n"), F.sum(F.aggregate("dls", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("tokens")).first()
    n = int(size["n"] or 0)
    return PostingIndex(table, keys, n, (size["tokens"] or 0) / n if n else 0.0)


def _weighted(index: PostingIndex, terms: DataFrame) -> DataFrame:
    """(block, term, rows, weights, bound) of the wanted terms' postings."""
    # Written once: it is read for the frequencies and for the weights.
    wanted = cut_lineage(index.table.where("term <> ''").select("block", "term", "rows", "tfs", "dls").join(terms, "term", "left_semi"))
    df = wanted.groupBy("term").agg(F.sum(F.size("rows")).cast("double").alias("df"))
    n, mean = F.lit(float(index.n_rows)), F.lit(index.mean_length or 1.0)
    idf = F.log(F.lit(1.0) + (n - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))

    def weight(x: Column) -> Column:
        tf = x["tfs"]
        return idf * tf * F.lit(BM25_K1 + 1.0) / (tf + F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * x["dls"] / mean))

    weights = wanted.join(df, "term").select("block", "term", "rows", F.transform(F.arrays_zip("tfs", "dls"), weight).alias("weights"))
    return cut_lineage(weights.withColumn("bound", F.array_max("weights")))


def _scored(index: PostingIndex, weighted: DataFrame, pairs: DataFrame, qid_type: T.DataType, k: int) -> DataFrame:
    """(qid, keys, score): the best ``k`` rows of every (query, block) in ``pairs`` (qid, block, terms).

    A task holds one block's postings and up to about ``QUERIES`` queries."""
    keys = index.keys
    names = [f"key_{i}" for i in range(len(keys))]
    counts = pairs.groupBy("block").agg(F.count(F.lit(1)).alias("queries"))
    asked = pairs.join(counts, "block").select("block", F.pmod(F.xxhash64("qid"), F.ceil(F.col("queries") / QUERIES)).cast("int").alias("part"),
                                               "qid", "terms")
    own = index.table.where("term = ''").select("block", "term", "rows", F.lit(None).cast("array<double>").alias("weights"), *names)
    postings = weighted.select("block", "term", "rows", "weights", *(F.lit(None).cast(own.schema[c].dataType).alias(c) for c in names)).unionByName(own)
    parts = asked.select("block", "part").distinct()
    postings = postings.join(parts.select(F.col("block").alias("b"), F.col("part").alias("p")), F.col("block") == F.col("b")).select(
        F.col("block").alias("block"), F.col("p").alias("part"), "term", "rows", "weights", *names)
    schema = T.StructType([T.StructField("qid", qid_type), *(T.StructField(c, own.schema[n].dataType.elementType) for c, n in zip(keys, names, strict=True)),
                           T.StructField("score", T.DoubleType())])

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
            column = block.column(name).combine_chunks()
            return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

        number = {t: i for i, t in enumerate(block.column("term").to_pylist())}
        at = number.get("", -1)
        if at < 0 or not queries.num_rows:
            return pa.table({f.name: [] for f in schema}).cast(to_arrow_schema(schema))
        (starts, rows), (weight_starts, weights) = flat("rows"), flat("weights")
        named = [block.column(n)[at].values for n in names]
        size = len(named[0])
        place = np.empty(size, np.int64)  # of a row in order of the keys
        place[pc.sort_indices(pa.table(dict(zip(names, named, strict=True))), [(n, "ascending") for n in names]).to_numpy()] = np.arange(size)
        chosen, scores, lengths = [], [], []
        for terms in queries.column("terms").to_pylist():
            ids = [number[t] for t in terms]
            row = np.concatenate([rows[starts[i]:starts[i + 1]] for i in ids])
            weight = np.concatenate([weights[weight_starts[i]:weight_starts[i + 1]] for i in ids])
            score = np.round(np.bincount(row, weight, minlength=size), SCORE_DECIMALS)
            hit = np.flatnonzero(score > 0)
            if len(hit) > k:
                hit = hit[score[hit] >= np.partition(score[hit], len(hit) - k)[len(hit) - k]]
            best = hit[np.lexsort((place[hit], -score[hit]))[:k]]
            chosen.append(best)
            scores.append(score[best])
            lengths.append(len(best))
        taken = pa.array(np.concatenate(chosen))
        qids = queries.column("qid").combine_chunks().take(pa.array(np.repeat(np.arange(queries.num_rows), lengths)))
        return pa.Table.from_arrays([qids, *(n.take(taken) for n in named), pa.array(np.concatenate(scores))], [f.name for f in schema])

    return postings.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(run, schema)


def search(index: PostingIndex, queries: DataFrame, qid_col: str, qtext_col: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """((qid, keys, score, rank), (qid, blocks, scored_blocks)).  Rows that share a term with the query
    are ranked by score (rounded), then keys."""
    kind = queries.schema[qid_col].dataType
    asked = cut_lineage(queries.select(F.col(qid_col).alias("qid"), F.explode(F.array_distinct(tokens(F.col(qtext_col)))).alias("term")))
    weighted = _weighted(index, asked.select("term").distinct())
    # What a query can reach in a block: the sum of its terms' greatest weights there.
    pairs = cut_lineage(asked.join(weighted.select("term", "block", "bound"), "term").groupBy("qid", "block").agg(
        F.sum("bound").alias("reach"), F.collect_list("term").alias("terms")))
    best = pairs.groupBy("qid").agg(F.max_by("block", F.struct("reach", "block")).alias("home"), F.count(F.lit(1)).alias("blocks"))
    placed = pairs.join(best, "qid")
    first = cut_lineage(_scored(index, weighted, placed.where("block = home"), kind, k))
    floor = first.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    rest = cut_lineage(placed.where("block <> home").join(floor, "qid", "left").where(
        (F.coalesce("n", F.lit(0)) < k) | (F.col("reach") >= F.col("kth") - SLACK)).select("qid", "block", "terms"))
    every = first.unionByName(_scored(index, weighted, rest, kind, k))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), *[F.col(c).asc() for c in index.keys])
    found = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    more = rest.groupBy("qid").agg(F.count(F.lit(1)).alias("more"))
    work = best.join(more, "qid", "left").select(F.col("qid").alias(qid_col), "blocks", (F.coalesce("more", F.lit(0)) + 1).alias("scored_blocks"))
    return found.select(F.col("qid").alias(qid_col), *index.keys, "score", "rank"), work


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, BLOCK_ROWS) for batch in batches for at in range(0, batch.num_rows, BLOCK_ROWS))


def bucket_of(term: str, features: int) -> int:
    """The first 32 bits of the term's md5, modulo the number of features."""
    return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % features


def text_vectors(corpus: DataFrame, keys: Sequence[str], text_col: str, features: int = FEATURES) -> DataFrame:
    """TF-IDF vectors of unit length as a sparse table: (keys, bucket, weight), a row per term bucket.

    A row's counts are made in one pass and written; the document frequencies, one number for each
    of ``features`` buckets at most, are all that the second pass needs besides.  Texts without a
    token have no rows; buckets of every text weigh 0 and a text of such buckets only keeps them at 0."""
    keys = list(keys)
    spark = corpus.sparkSession
    ship_package(spark)
    ints = T.ArrayType(T.IntegerType())
    key_fields = [corpus.schema[c] for c in keys]
    counted = T.StructType([*key_fields, T.StructField("buckets", ints), T.StructField("tfs", ints)])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, memo = re.compile(TOKEN).findall, {}
        for part in _parts(batches):
            found = [find(t.lower()) if t else [] for t in part.column(len(keys)).to_pylist()]
            number: dict[str, int] = defaultdict(_counter())
            ids = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64)
            if len(memo) >= 1 << 18:  # bounded: it starts afresh
                memo.clear()
            for term in number:
                if term not in memo:
                    memo[term] = bucket_of(term, features)
            bucket = np.array([memo[term] for term in number], np.int64)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            # Sorted by row and then bucket.
            pair, tf = np.unique(np.repeat(np.arange(len(found)), lengths) * features + bucket[ids], return_counts=True)
            offsets = pa.array(np.searchsorted(pair, np.arange(len(found) + 1) * features), pa.int32())
            yield pa.RecordBatch.from_arrays([
                *part.columns[:len(keys)], pa.ListArray.from_arrays(offsets, pa.array(pair % features, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], counted.names)

    rows = cut_lineage(spread(corpus.select(*keys, F.col(text_col).alias("text"))).mapInArrow(frequencies, counted))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features, np.int64)
        for part in batches:
            total += np.bincount(part.column(0).flatten().to_numpy(), minlength=features)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["b", "n"])

    n, df = rows.count(), np.zeros(features)
    for r in rows.select("buckets").mapInArrow(totals, "b long, n long").groupBy("b").agg(
            F.sum("n").alias("n")).toLocalIterator():  # at most ``features`` rows
        df[r["b"]] = r["n"]
    idf = spark.sparkContext.broadcast(np.log((n + 1.0) / (df + 1.0)))
    out = T.StructType([*key_fields, T.StructField("bucket", T.IntegerType()), T.StructField("weight", T.DoubleType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            buckets, tfs = part.column(len(keys)), part.column(len(keys) + 1).flatten().to_numpy()
            row = np.repeat(np.arange(part.num_rows), buckets.value_lengths().to_numpy())
            w = tfs * idf.value[buckets.flatten().to_numpy()]
            norm = np.sqrt(np.bincount(row, w * w, minlength=part.num_rows))
            w = w / np.where(norm > 0, norm, 1.0)[row]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in part.columns[:len(keys)]), buckets.flatten(), pa.array(w)], out.names)

    return rows.mapInArrow(weigh, out)
