"""Text, retrieval and evaluation queries over ``documents``, ``benchmark``,
``conversations`` and ``embeddings``.

Corpus: fixed 1024/128 character chunks of every document.  Queries: every
``benchmark`` passage (first stage BM25 k=10, second stage token overlap n=3).
Vector retrieval: one query per label, the label's mean embedding, k=10 by cosine.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import after_marker
from tessera.operators import cells as C
from tessera.operators import chunking as CH
from tessera.operators import evaluation as EV
from tessera.operators import postings as P
from tessera.operators import retrieval as R
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir
from tessera.sources import read_scores_csv, read_table, write_scores_csv

K = 10
N_KEEP = 3
#: Approximate search: every vector whose id this divides is a query; cells probed; sketch bits that may differ.
QUERY_EVERY, PROBES, RADIUS = 20, 13, 232
STEP = CH.CHUNK_SIZE - CH.CHUNK_OVERLAP
TOK = R.TOKEN


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_CHUNKS_SQL = f"""
ch AS (
  SELECT doc_id, lang, CAST(s.char_start AS INTEGER) AS char_start,
         CAST(s.char_start // {STEP} AS INTEGER) AS chunk_pos,
         substring(s.text, s.char_start + 1, {CH.CHUNK_SIZE}) AS chunk
  FROM (SELECT doc_id, lang, text, unnest(CASE WHEN length(text) = 0 THEN []::BIGINT[]
          ELSE range(0, (greatest(1, CAST(ceil((length(text) - {CH.CHUNK_OVERLAP}) / {STEP}.0) AS BIGINT)) - 1)
                     * {STEP} + 1, {STEP}) END) AS char_start
        FROM documents) s)"""

_STAGE1_SQL = f"""
q AS (SELECT item_id, text FROM benchmark),
qa AS (SELECT item_id, regexp_extract_all(lower(text), '{TOK}', 0) AS toks FROM q),
qt AS (SELECT DISTINCT item_id, unnest(toks) AS term FROM qa),
ct0 AS (SELECT doc_id, chunk_pos, regexp_extract_all(lower(chunk), '{TOK}', 0) AS toks FROM ch),
stats AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(toks)) AS avgdl FROM ct0),
ct AS (SELECT doc_id, chunk_pos, len(toks) AS dl, unnest(toks) AS term FROM ct0),
tf AS (SELECT doc_id, chunk_pos, dl, term, count(*) AS tf FROM ct
       WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
dfq AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY term),
w AS (SELECT tf.doc_id, tf.chunk_pos, tf.term,
        ln(1.0::DOUBLE + (stats.n - dfq.df + 0.5::DOUBLE) / (dfq.df + 0.5::DOUBLE))
        * tf.tf * ({R.BM25_K1}::DOUBLE + 1.0::DOUBLE)
        / (tf.tf + {R.BM25_K1}::DOUBLE * (1.0::DOUBLE - {R.BM25_B}::DOUBLE
                                          + {R.BM25_B}::DOUBLE * tf.dl / stats.avgdl)) AS w
      FROM tf JOIN dfq USING (term) CROSS JOIN stats),
sc AS (SELECT qt.item_id, w.doc_id, w.chunk_pos, round(sum(w.w), {R.SCORE_DECIMALS}) AS score
       FROM w JOIN qt USING (term) GROUP BY ALL),
top AS (SELECT item_id, doc_id, chunk_pos, score,
          CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_pos) AS INTEGER) AS rank
        FROM sc WHERE score > 0 QUALIFY rank <= {K})"""

_STAGE2_SQL = f"""
rr AS (
  SELECT t.item_id, t.doc_id, t.chunk_pos, t.rank AS stage1_rank, t.score AS stage1_score,
    CAST(len(list_intersect(list_distinct(qa.toks), list_distinct(ca.toks))) AS DOUBLE)
      / len(list_distinct(list_concat(qa.toks, ca.toks))) AS score
  FROM top t JOIN qa USING (item_id) JOIN ct0 ca USING (doc_id, chunk_pos)),
kept AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, stage1_rank) AS INTEGER) AS rank
  FROM rr QUALIFY rank <= {N_KEEP}),
ctx AS (
  SELECT k.item_id, count(*) AS n_passages,
         string_agg(c.chunk, chr(10) || chr(10) ORDER BY k.rank) AS context
  FROM kept k JOIN ch c USING (doc_id, chunk_pos) GROUP BY k.item_id)"""

_HEAD, _REST = R.PROMPT_TEMPLATE.split("{context}")
_MID, _TAIL = _REST.split("{question}")

_EVAL_SQL = f"""
er AS (
  SELECT k.item_id, list(c.chunk ORDER BY k.rank) AS retrieved_contexts
  FROM kept k JOIN ch c USING (doc_id, chunk_pos) GROUP BY k.item_id),
rows AS (
  SELECT er.item_id, q.text AS user_input, trim(regexp_extract(c.chunk, '(?s)^([^.!?]*[.!?]?)', 1)) AS response, retrieved_contexts
  FROM er JOIN q USING (item_id) JOIN top t ON t.item_id = er.item_id AND t.rank = 1
    JOIN ch c ON c.doc_id = t.doc_id AND c.chunk_pos = t.chunk_pos),
tk AS (
  SELECT item_id, user_input, list_distinct(regexp_extract_all(lower(response), '{TOK}', 0)) AS a,
         list_distinct(regexp_extract_all(lower(user_input), '{TOK}', 0)) AS b,
         list_distinct(regexp_extract_all(lower(array_to_string(retrieved_contexts, chr(10) || chr(10))), '{TOK}', 0)) AS c
  FROM rows),
ev AS (
  SELECT tk.item_id, user_input,
    CASE WHEN len(a) = 0 THEN 0.0::DOUBLE ELSE CAST(len(list_intersect(a, c)) AS DOUBLE) / len(a) END AS faithfulness,
    CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) AS answer_relevancy,
    m.avg_score AS nv_context_relevance
  FROM tk JOIN (SELECT item_id, avg(score) AS avg_score FROM kept GROUP BY 1) m USING (item_id)),
lab AS (
  SELECT 'Q' || CAST(row_number() OVER (ORDER BY item_id) AS VARCHAR) AS q,
         substring(user_input, 1, {EV.QUESTION_CHARS}) || '…' AS question, *
  FROM ev),
lng AS (
  SELECT q, question, 'faithfulness' AS metric, faithfulness AS score FROM lab
  UNION ALL SELECT q, question, 'answer_relevancy', answer_relevancy FROM lab
  UNION ALL SELECT q, question, 'nv_context_relevance', nv_context_relevance FROM lab)"""

_KNN_SQL = f"""
cen AS (
  SELECT label, list(avg_v ORDER BY pos) AS c FROM (
    SELECT label, pos, avg(v) AS avg_v FROM (
      SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY 1, 2)
  GROUP BY 1),
sim AS (
  SELECT cen.label, e.vec_id,
    round(list_inner_product(cen.c, e.embedding::DOUBLE[])
          / (sqrt(list_inner_product(cen.c, cen.c))
             * sqrt(list_inner_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))), {R.SCORE_DECIMALS}) AS score
  FROM cen CROSS JOIN embeddings e),
nb AS (
  SELECT label, vec_id, score,
         CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM sim WHERE score IS NOT NULL AND NOT isnan(score) QUALIFY rank <= {K})"""


# --- Spark side --------------------------------------------------------------------

def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return CH.fixed_chunks(docs, carry=["lang"])


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark").select("item_id", "text")


def _stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.bm25_top_k(_queries(spark, sf_dir), _chunks(spark, sf_dir), "item_id", "text",
                        ["doc_id", "chunk_pos"], "chunk", k=K)


def _chunks_of(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Chunks of the documents that ``rows`` name: only their texts are cut again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return CH.fixed_chunks(docs.join(rows.select("doc_id").distinct(), "doc_id", "left_semi"), carry=["lang"])


def _two_stages(spark: SparkSession, sf_dir: str, scorer=R.jaccard) -> tuple[DataFrame, DataFrame]:
    """(first-stage candidates, kept rows)."""
    candidates = _stage1(spark, sf_dir)
    kept = R.rerank(candidates, _queries(spark, sf_dir), _chunks_of(spark, sf_dir, candidates),
                    "item_id", "text", ["doc_id", "chunk_pos"], "chunk", n=N_KEEP, scorer=scorer)
    return candidates, kept


def _context(spark: SparkSession, sf_dir: str, kept: DataFrame) -> DataFrame:
    return R.assemble_context(kept, _chunks_of(spark, sf_dir, kept), _queries(spark, sf_dir), "item_id",
                              "text", ["doc_id", "chunk_pos"], "chunk")


def _eval_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    candidates, kept = _two_stages(spark, sf_dir)
    best = candidates.where("rank = 1").select("doc_id").union(kept.select("doc_id"))
    rows = EV.eval_rows(kept, candidates, _chunks_of(spark, sf_dir, best), _queries(spark, sf_dir), "item_id", "text",
                        ["doc_id", "chunk_pos"], "chunk")
    return rows, kept


def _eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, kept = _eval_rows(spark, sf_dir)
    return EV.support_scores(rows, kept, "item_id")


@register("doc_chunks_fixed", f"""
WITH {_CHUNKS_SQL}
SELECT doc_id, lang, chunk_pos, char_start, CAST(length(chunk) AS INTEGER) AS n_chars, chunk FROM ch""")
def doc_chunks_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir)


@register("doc_chunk_stats", f"""
WITH {_CHUNKS_SQL}
SELECT lang, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS total_chars,
       CAST(sum(length(chunk)) // count(*) AS BIGINT) AS avg_chars
FROM ch GROUP BY lang""")
def doc_chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.chunk_stats(_chunks(spark, sf_dir), ["lang"])


def _cut_sql(start: str) -> str:
    """End of the window that starts at ``start``: behind the last separator in its further half."""
    size, least = CH.CHUNK_SIZE, max(CH.CHUNK_SIZE // 2, CH.CHUNK_OVERLAP)
    back = f"reverse(substring(text, {start} + {least} + 1, {size - least}))"
    cases = " ".join(f"WHEN strpos({back}, {sep}) > 0 THEN {start} + {size} - strpos({back}, {sep}) + 1"
                     for sep in ("chr(10) || chr(10)", "chr(10)", "' '"))
    return f"CASE WHEN {start} + {size} >= n THEN n {cases} ELSE {start} + {size} END"


_NEXT_SQL = f"""
  CASE WHEN strpos(translate(substring(text, e - {CH.CHUNK_OVERLAP} + 1, {CH.CHUNK_OVERLAP - 1}), chr(10), ' '), ' ') > 0
       THEN e - {CH.CHUNK_OVERLAP} + strpos(translate(substring(text, e - {CH.CHUNK_OVERLAP} + 1, {CH.CHUNK_OVERLAP - 1}), chr(10), ' '), ' ')
       ELSE e - {CH.CHUNK_OVERLAP} END"""


@register("doc_chunks_recursive", f"""
WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE text <> ''),
c AS (
  SELECT doc_id, 0 AS chunk_pos, CAST(0 AS BIGINT) AS s, CAST({_cut_sql('0')} AS BIGINT) AS e FROM d
  UNION ALL
  SELECT doc_id, chunk_pos + 1, s, CAST({_cut_sql('s')} AS BIGINT)
  FROM (SELECT doc_id, text, n, chunk_pos, CAST({_NEXT_SQL} AS BIGINT) AS s FROM c JOIN d USING (doc_id) WHERE e < n) t)
SELECT doc_id, CAST(chunk_pos AS INTEGER) AS chunk_pos, CAST(s AS INTEGER) AS char_start, CAST(e - s AS INTEGER) AS n_chars,
       substring(text, s + 1, e - s) AS chunk
FROM c JOIN d USING (doc_id)""")
def doc_chunks_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return CH.recursive_chunks(docs)


@register("retrieve_bm25", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}
SELECT item_id, doc_id, chunk_pos, score, rank FROM top""")
def retrieve_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage1(spark, sf_dir).select("item_id", "doc_id", "chunk_pos", "score", "rank")


@register("rerank_lexical", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}
SELECT item_id, doc_id, chunk_pos, stage1_rank, stage1_score, score, rank FROM kept""")
def rerank_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_stages(spark, sf_dir)[1]


@register("rerank_coverage", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL},
rr AS (
  SELECT t.item_id, t.doc_id, t.chunk_pos, t.rank AS stage1_rank, t.score AS stage1_score,
    CAST(len(list_intersect(list_distinct(qa.toks), list_distinct(ca.toks))) AS DOUBLE) / len(list_distinct(qa.toks)) AS score
  FROM top t JOIN qa USING (item_id) JOIN ct0 ca USING (doc_id, chunk_pos))
SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, stage1_rank) AS INTEGER) AS rank
FROM rr QUALIFY rank <= {N_KEEP}""")
def rerank_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second stage with another scorer: share of the question's tokens in the passage."""
    return _two_stages(spark, sf_dir, R.coverage)[1]


@register("context_prompt", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}
SELECT ctx.item_id, n_passages, context,
       {_sql_str(_HEAD)} || context || {_sql_str(_MID)} || q.text || {_sql_str(_TAIL)} AS prompt
FROM ctx JOIN q USING (item_id)""")
def context_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir, _two_stages(spark, sf_dir)[1])


#: A marker that does occur in the given conversations; the operator's usual one is tested inline.
ANSWER_MARKER = ". "


@register("answer_clean", f"""
SELECT conv_id, turn, role,
  CASE WHEN instr(text, '{ANSWER_MARKER}') > 0
       THEN regexp_replace(string_split(text, '{ANSWER_MARKER}')[-1], '^\\s+|\\s+$', '', 'g')
       ELSE text END AS answer
FROM conversations""")
def answer_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", "role", after_marker(F.col("text"), ANSWER_MARKER).alias("answer"))


@register("eval_rows", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL.rsplit("lab AS (", 1)[0].rstrip().rstrip(",")}
SELECT item_id, user_input, response, retrieved_contexts FROM rows""")
def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval_rows(spark, sf_dir)[0]


@register("eval_scores", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL}
SELECT item_id, user_input, faithfulness, answer_relevancy, nv_context_relevance FROM ev""", rounded=('faithfulness', 'answer_relevancy', 'nv_context_relevance'))
def eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval(spark, sf_dir)


@register("score_summary", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL}
SELECT metric, count(score) AS n, avg(score) AS mean, min(score) AS min, max(score) AS max
FROM lng GROUP BY metric""", rounded=('mean', 'min', 'max'))
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.score_summary(_eval(spark, sf_dir))


@register("score_grid", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL}
SELECT q, question, metric, score,
  CASE WHEN score IS NULL THEN NULL WHEN score > {EV.GOOD_ABOVE}::DOUBLE THEN 'acceptable'
       WHEN score < {EV.WEAK_BELOW}::DOUBLE THEN 'problem' ELSE 'borderline' END AS band,
  CASE WHEN least(greatest(score, 0.0::DOUBLE), 1.0::DOUBLE) < {EV.WHITE_BELOW}::DOUBLE
         OR least(greatest(score, 0.0::DOUBLE), 1.0::DOUBLE) > {EV.WHITE_ABOVE}::DOUBLE
       THEN 'white' ELSE 'black' END AS text_colour
FROM lng""", rounded=('score',))
def score_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = EV.label_questions(_eval(spark, sf_dir), "item_id", "user_input")
    return EV.score_grid(labelled)


@register("score_extremes", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL},
nn AS (SELECT q, metric, score FROM lng WHERE score IS NOT NULL)
SELECT 'lowest' AS kind, CAST(row_number() OVER (ORDER BY score ASC, q, metric) AS INTEGER) AS pos, q, metric, score
FROM nn QUALIFY pos <= 3
UNION ALL
SELECT 'highest', CAST(row_number() OVER (ORDER BY score DESC, q, metric) AS INTEGER) AS pos, q, metric, score
FROM nn QUALIFY pos <= 3""", rounded=('score',))
def score_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = EV.label_questions(_eval(spark, sf_dir), "item_id", "user_input")
    return EV.score_extremes(labelled, 3)


@register("csv_round_trip", f"""
WITH {_CHUNKS_SQL}, {_STAGE1_SQL}, {_STAGE2_SQL}, {_EVAL_SQL}
SELECT user_input, faithfulness, answer_relevancy, nv_context_relevance FROM ev""", rounded=('faithfulness', 'answer_relevancy', 'nv_context_relevance'))
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "csv_round_trip", uuid.uuid4().hex)
    write_scores_csv(_eval(spark, sf_dir).drop("item_id"), path)
    return read_scores_csv(spark, path)


@register("knn_exact", f"""
WITH {_KNN_SQL}
SELECT label, vec_id, score, rank FROM nb""")
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir).select(F.col("label").cast("int").alias("label"), "vec_id", "score", "rank")


def _centroids(emb: DataFrame) -> DataFrame:
    """Mean vector per label: ``posexplode`` + ``groupBy(label, pos)`` (partial
    aggregation), then one ordered array per label (dimension-bounded)."""
    per_dim = (
        emb.select("label", F.posexplode("embedding").alias("pos", "v"))
        .groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    )
    return per_dim.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("c"))


def _index(spark: SparkSession, sf_dir: str) -> C.CellIndex:
    return C.build(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), ["vec_id"], "embedding")


def _knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.exact(_index(spark, sf_dir), _centroids(read_table(spark, sf_dir, "embeddings")), "label", "c", k=K)[0]


# Cells, sketches and angles as the index has them; queries are the vectors whose id 20 divides.
_CELLS_SQL = f"""
e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: x / norm) AS u FROM e WHERE norm > 0),
piv AS (SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS cell, u AS p FROM u QUALIFY cell < {C.CELLS}),
near AS (
  SELECT u.vec_id, u.u, piv.cell, round(list_inner_product(u.u, piv.p), {C.SCORE_DECIMALS}) AS s FROM u CROSS JOIN piv),
placed AS (SELECT vec_id, u, cell, acos(least(1.0, greatest(-1.0, s))) AS angle FROM near
           QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) = 1)"""

_SKETCH_SQL = f"""
drawn AS (
  SELECT b, i, CASE WHEN substr(md5(b::VARCHAR || ':' || i::VARCHAR), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS r
  FROM range({C.BITS}) t1(b) CROSS JOIN (SELECT unnest(range(len(u))) AS i FROM (SELECT u FROM u LIMIT 1))),
signs AS (SELECT b, list(r ORDER BY i) AS r FROM drawn GROUP BY b),
sk AS (
  SELECT vec_id, string_agg(CASE WHEN list_inner_product(u, r) >= 0 THEN '1' ELSE '0' END, '' ORDER BY b) AS sketch
  FROM u CROSS JOIN signs GROUP BY vec_id),
probed AS (
  SELECT n.vec_id AS qid, n.u AS q, n.cell, sk.sketch FROM near n JOIN sk USING (vec_id) WHERE n.vec_id % {QUERY_EVERY} = 0
  QUALIFY row_number() OVER (PARTITION BY n.vec_id ORDER BY n.s DESC, n.cell) <= {PROBES}),
pairs AS (
  SELECT p.qid, x.vec_id, round(list_inner_product(p.q, x.u), {C.SCORE_DECIMALS}) AS score,
         hamming(p.sketch, k.sketch) <= {RADIUS} AS compared
  FROM probed p JOIN placed x USING (cell) JOIN sk k ON k.vec_id = x.vec_id),
approx AS (
  SELECT qid, vec_id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs WHERE compared QUALIFY rank <= {K}),
truth AS (
  SELECT a.vec_id AS qid, b.vec_id FROM u a CROSS JOIN u b WHERE a.vec_id % {QUERY_EVERY} = 0
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_inner_product(a.u, b.u), {C.SCORE_DECIMALS}) DESC, b.vec_id) <= {K})"""


def _cell_search(spark: SparkSession, sf_dir: str) -> tuple[C.CellIndex, DataFrame, tuple[DataFrame, DataFrame]]:
    index = _index(spark, sf_dir)
    queries = read_table(spark, sf_dir, "embeddings").where(F.col("vec_id") % QUERY_EVERY == 0).select(
        F.col("vec_id").alias("qid"), "embedding")
    return index, queries, C.approximate(index, queries, "qid", "embedding", k=K, probes=PROBES, radius=RADIUS)


@register("knn_cells", f"""
WITH {_CELLS_SQL}, {_SKETCH_SQL}
SELECT qid, vec_id, score, rank FROM approx""")
def knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate neighbours of every vector whose id 20 divides, from probed cells and sketches."""
    return _cell_search(spark, sf_dir)[2][0]


@register("knn_cells_recall", f"""
WITH {_CELLS_SQL}, {_SKETCH_SQL},
hits AS (SELECT qid, count(*) AS hits FROM truth JOIN approx USING (qid, vec_id) GROUP BY qid),
work AS (SELECT qid, count(*) AS sketched, count(*) FILTER (compared) AS compared FROM pairs GROUP BY qid)
SELECT t.qid, coalesce(any_value(hits), 0) AS hits, any_value(sketched) AS sketched, any_value(compared) AS compared,
       coalesce(any_value(hits), 0) / CAST(count(*) AS DOUBLE) AS recall,
       any_value(compared) / (SELECT CAST(count(*) AS DOUBLE) FROM embeddings) AS share_compared
FROM truth t LEFT JOIN hits USING (qid) LEFT JOIN work USING (qid) GROUP BY t.qid""", rounded=("recall", "share_compared"))
def knn_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of ``knn_cells`` against the exact search, with the rows sketched and compared."""
    index, queries, (found, counted) = _cell_search(spark, sf_dir)
    truth, _ = C.exact(index, queries, "qid", "embedding", k=K)
    total = read_table(spark, sf_dir, "embeddings").count()
    return C.recall(found, truth, counted, "qid", ["vec_id"], total, K)


@register("knn_blocks_read", f"""
WITH {_KNN_SQL}, {_CELLS_SQL},
bounds AS (SELECT cell, count(*) AS n, min(angle) AS low, max(angle) AS high FROM placed GROUP BY cell),
qa AS (
  SELECT label, piv.cell, round(list_inner_product(c, p) / sqrt(list_inner_product(c, c)), {C.SCORE_DECIMALS}) AS s FROM cen CROSS JOIN piv),
qp AS (SELECT *, acos(least(1.0, greatest(-1.0, s))) AS angle, row_number() OVER (PARTITION BY label ORDER BY s DESC, cell) AS place FROM qa),
home AS (
  SELECT label, score FROM qp JOIN placed USING (cell) JOIN sim USING (label, vec_id) WHERE place = 1
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC) <= {K}),
kth AS (SELECT label, CASE WHEN count(*) >= {K} THEN acos(least(1.0, greatest(-1.0, min(score)))) + {C.SLACK} ELSE 4.0 END AS reach FROM home GROUP BY label)
SELECT qp.label::INTEGER AS label, CAST(sum(n) AS BIGINT) AS compared, count(*) AS blocks_read,
       sum(n) / (SELECT CAST(count(*) AS DOUBLE) FROM placed) AS share_read
FROM qp JOIN bounds USING (cell) LEFT JOIN kth USING (label)
WHERE place = 1 OR greatest(0.0, angle - high, low - angle) <= coalesce(reach, 4.0) GROUP BY qp.label""", rounded=("share_read",))
def knn_blocks_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and blocks that the exact search of ``knn_exact`` reads for each query."""
    emb = read_table(spark, sf_dir, "embeddings")
    index = _index(spark, sf_dir)
    _, read = C.exact(index, _centroids(emb), "label", "c", k=K)
    return read.select(F.col("label").cast("int").alias("label"), "compared", "blocks_read",
                       (F.col("compared") / F.lit(float(max(index.blocks.agg(F.sum("n")).first()[0] or 0, 1)))).alias("share_read"))


@register("retrieval_scores", f"""
WITH {_KNN_SQL},
pop AS (SELECT label, count(*) AS pop FROM embeddings GROUP BY label),
per AS (
  SELECT nb.label, CAST(sum(CASE WHEN e.label = nb.label THEN 1 ELSE 0 END) AS BIGINT) AS hits,
         min(CASE WHEN e.label = nb.label THEN nb.rank END) AS first_hit
  FROM nb JOIN embeddings e USING (vec_id) GROUP BY nb.label)
SELECT per.label, hits, hits / {float(K)}::DOUBLE AS precision_at_k, CAST(hits AS DOUBLE) / pop AS recall_at_k,
       coalesce(1.0::DOUBLE / first_hit, 0.0::DOUBLE) AS mrr
FROM per JOIN pop USING (label)""", rounded=('precision_at_k', 'recall_at_k', 'mrr'))
def retrieval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    nb = _knn(spark, sf_dir).withColumn("label", F.col("label").cast("int"))
    return EV.label_retrieval_scores(nb, emb.select("vec_id", "label"), "label", "vec_id", "label", K)


@register("knn_lsh_recall")
def knn_lsh_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    cen = _centroids(emb)
    approx = R.lsh_top_k(cen, emb, "label", "c", "vec_id", "embedding", k=K)
    exact = _knn(spark, sf_dir).select("label", "vec_id")
    return R.recall_at_k(approx, exact, "label", "vec_id", K)


@register("chunk_tfidf_vectors", f"""
WITH {_CHUNKS_SQL},
tk AS (
  SELECT doc_id, chunk_pos, CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % {P.FEATURES} AS INTEGER) AS bucket
  FROM (SELECT doc_id, chunk_pos, unnest(regexp_extract_all(lower(chunk), '{TOK}', 0)) AS term FROM ch)),
tf AS (SELECT doc_id, chunk_pos, bucket, count(*) AS tf FROM tk GROUP BY ALL),
df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
w AS (
  SELECT doc_id, chunk_pos, bucket, tf * ln(((SELECT count(*) FROM ch) + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) AS w FROM tf JOIN df USING (bucket)),
norm AS (SELECT doc_id, chunk_pos, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL)
SELECT doc_id, chunk_pos, bucket, CASE WHEN norm > 0 THEN w / norm ELSE w END AS weight FROM w JOIN norm USING (doc_id, chunk_pos)""",
          rounded=("weight",))
def chunk_tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF vectors of all chunks as a sparse table."""
    return P.text_vectors(_chunks(spark, sf_dir), ["doc_id", "chunk_pos"], "chunk")
