import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.text import after_marker, trim_ws, truncate_ellipsis
from tessera.operators import chunking as CH
from tessera.operators import postings
from tessera.operators import retrieval as R


def test_fixed_chunks_rebuild_text(spark):
    rng = random.Random(1)
    texts = ["", "short", "x" * 1024, "y" * 1025] + ["".join(rng.choice("ab \n") for _ in range(rng.randint(1, 5000)))
                                                    for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = CH.fixed_chunks(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert 0 not in by_doc
    for i, t in enumerate(texts):
        if not t:
            continue
        chunks = sorted(by_doc[i], key=lambda r: r["chunk_pos"])
        rebuilt = chunks[0]["chunk"] + "".join(c["chunk"][128:] for c in chunks[1:])
        assert rebuilt == t
        assert all(c["n_chars"] <= 1024 for c in chunks)
        assert [c["char_start"] for c in chunks] == [896 * k for k in range(len(chunks))]


def test_recursive_chunks_distributed(spark):
    text = "para one.\n\npara two " * 200
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "a b c")], "doc_id BIGINT, text STRING")
    rows = sorted(CH.recursive_chunks(docs).collect(), key=lambda r: (r["doc_id"], r["chunk_pos"]))
    assert [(r["char_start"], r["char_start"] + r["n_chars"]) for r in rows if r["doc_id"] == 1] == list(CH.cut_places(text))
    assert all(r["chunk"] == text[r["char_start"]:r["char_start"] + r["n_chars"]] for r in rows if r["doc_id"] == 1)
    assert [r["chunk"] for r in rows if r["doc_id"] > 1] == ["a b c"]
    # the coarsest separator far enough in the window ends the chunk
    assert list(CH.cut_places("aaaa bbbb\ncc dd eeee", 14, 3))[0] == (0, 10)
    assert list(CH.cut_places("x" * 30, 14, 4)) == [(0, 14), (10, 24), (20, 30)]


def test_string_helpers(spark):
    df = spark.createDataFrame([("<think>x</think>  answer \n",), ("plain",), ("a</think>b</think>\tc",)], "t STRING")
    out = [r[0] for r in df.select(after_marker(F.col("t"), "</think>")).collect()]
    assert out == ["answer", "plain", "c"]
    assert df.select(truncate_ellipsis(F.lit("abc"), 65)).first()[0] == "abc…"
    assert df.select(trim_ws(F.lit("\n\t x \r"))).first()[0] == "x"


def _bm25_brute(queries, docs, k):
    tok = lambda s: re.findall(R.TOKEN, s.lower())
    dtoks = [tok(d) for d in docs]
    n, avgdl = len(docs), sum(map(len, dtoks)) / len(docs)
    out = {}
    for qi, q in enumerate(queries):
        qt = set(tok(q))
        scores = []
        for di, dt in enumerate(dtoks):
            s = 0.0
            for t in qt:
                tf = dt.count(t)
                if tf:
                    df = sum(1 for x in dtoks if t in x)
                    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
                    s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(dt) / avgdl))
            if s > 0:
                scores.append((-round(s, 9), di))
        out[qi] = [di for _, di in sorted(scores)[:k]]
    return out


def test_bm25_top_k_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = ["red", "blue", "green", "cat", "dog", "fish", "sun", "moon", "tree", "rock"]
    docs = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    queries = [" ".join(rng.sample(vocab, 2)) for _ in range(6)]
    corpus = spark.createDataFrame([(i, 0, d) for i, d in enumerate(docs)], "doc_id BIGINT, chunk_pos INT, chunk STRING")
    q = spark.createDataFrame(list(enumerate(queries)), "qid BIGINT, text STRING")
    got = R.bm25_top_k(q, corpus.repartition(4), "qid", "text", ["doc_id", "chunk_pos"], "chunk", k=5).collect()
    exp = _bm25_brute(queries, docs, 5)
    for qi in range(len(queries)):
        mine = [r["doc_id"] for r in sorted((r for r in got if r["qid"] == qi), key=lambda r: r["rank"])]
        assert mine == exp[qi]


def test_cosine_top_k_matches_numpy(spark):
    rng = np.random.default_rng(3)
    V = rng.normal(size=(300, 8))
    Q = rng.normal(size=(4, 8))
    corpus = spark.createDataFrame([(i, V[i].tolist()) for i in range(300)], "vec_id BIGINT, v ARRAY<DOUBLE>")
    q = spark.createDataFrame([(i, Q[i].tolist()) for i in range(4)], "qid BIGINT, c ARRAY<DOUBLE>")
    got = R.cosine_top_k(q, corpus.repartition(5), "qid", "c", ["vec_id"], "v", k=7).collect()
    S = (V / np.linalg.norm(V, axis=1)[:, None]) @ (Q / np.linalg.norm(Q, axis=1)[:, None]).T
    for qi in range(4):
        mine = [r["vec_id"] for r in sorted((r for r in got if r["qid"] == qi), key=lambda r: r["rank"])]
        assert mine == list(np.argsort(-S[:, qi], kind="stable")[:7])


def test_rerank_and_context(spark):
    corpus = spark.createDataFrame([(1, 0, "red cat"), (2, 0, "red dog sun"), (3, 0, "blue fish")],
                                   "doc_id BIGINT, chunk_pos INT, chunk STRING")
    q = spark.createDataFrame([(7, "red cat sun")], "qid BIGINT, text STRING")
    cand = R.bm25_top_k(q, corpus, "qid", "text", ["doc_id", "chunk_pos"], "chunk", k=10)
    kept = R.rerank(cand, q, corpus, "qid", "text", ["doc_id", "chunk_pos"], "chunk", n=1).collect()
    assert [r["doc_id"] for r in kept] == [1]
    ctx = R.assemble_context(spark.createDataFrame(kept), corpus, q, "qid", "text", ["doc_id", "chunk_pos"],
                             "chunk").first()
    assert ctx["context"] == "red cat"
    assert ctx["prompt"].endswith("Question: red cat sun\n<think>\n")


def test_bound_pruning_keeps_ties_and_reads_few_blocks(spark):
    """Small blocks, hot terms, equal scores across blocks, queries that match little or nothing."""
    rng = random.Random(9)
    docs = [" ".join(["the"] + [f"w{int(rng.expovariate(0.02))}" for _ in range(rng.randint(1, 15))]) for _ in range(400)]
    docs += docs[:30] + ["", None, "the"]
    queries = [docs[i] for i in range(0, 400, 40)] + ["the", "zzz", "the zzz w1 W1", ""]
    corpus = spark.createDataFrame([(i, 0, d) for i, d in enumerate(docs)], "doc_id BIGINT, chunk_pos INT, chunk STRING")
    q = spark.createDataFrame(list(enumerate(queries)), "qid BIGINT, text STRING")
    index = postings.build(corpus.repartition(4), ["doc_id", "chunk_pos"], "chunk", block_rows=8)
    assert index.n_rows == len(docs)
    found, work = postings.search(index, q, "qid", "text", k=4)
    exp = _bm25_brute(queries, [d or "" for d in docs], 4)
    got = found.collect()
    for qi in range(len(queries)):
        assert [r["doc_id"] for r in sorted((r for r in got if r["qid"] == qi), key=lambda r: r["rank"])] == exp[qi], queries[qi]
    blocks = index.table.where("term = ''").count()
    done = {r["qid"]: (r["blocks"], r["scored_blocks"]) for r in work.collect()}
    assert all(1 <= s <= c <= blocks for c, s in done.values())
    # Where a block's own words decide, the others are not scored although they hold "the".
    grouped = spark.createDataFrame([(i, 0, f"the t{i // 8}a t{i // 8}b") for i in range(160)], "doc_id BIGINT, chunk_pos INT, chunk STRING")
    ask = spark.createDataFrame([(b, f"the t{b}a t{b}b") for b in range(20)], "qid BIGINT, text STRING")
    top, work = postings.search(postings.build(grouped.repartitionByRange(40, "doc_id"), ["doc_id", "chunk_pos"], "chunk", block_rows=8), ask, "qid", "text", k=4)
    assert {(r["qid"], r["doc_id"]) for r in top.collect()} == {(b, 8 * b + i) for b in range(20) for i in range(4)}
    assert sum(r["scored_blocks"] for r in work.collect()) < 0.3 * sum(r["blocks"] for r in work.collect())
    again, _ = postings.search(index, q.where("qid < 3"), "qid", "text", k=4)  # one index, another query table
    assert sorted(map(tuple, again.collect())) == sorted(tuple(r) for r in got if r["qid"] < 3)
    assert postings.search(index, q.limit(0), "qid", "text")[0].count() == 0
    empty = postings.build(corpus.limit(0), ["doc_id", "chunk_pos"], "chunk")
    assert postings.search(empty, q, "qid", "text")[0].count() == 0


def test_text_vectors_are_unit_tf_idf_rows(spark):
    docs = [(1, "red cat red"), (2, "red dog"), (3, "red"), (4, None), (5, "")]
    rows = postings.text_vectors(spark.createDataFrame(docs, "doc_id BIGINT, chunk STRING"), ["doc_id"], "chunk", 64).collect()
    by = {(r.doc_id, r.bucket): r.weight for r in rows}
    b = {t: postings.bucket_of(t, 64) for t in ("red", "cat", "dog")}
    assert len(set(b.values())) == 3 and set(by) == {(1, b["red"]), (1, b["cat"]), (2, b["red"]), (2, b["dog"]), (3, b["red"])}
    red, rare = 2 * np.log(6 / 4), np.log(6 / 2)
    assert abs(by[1, b["cat"]] - rare / np.hypot(red, rare)) < 1e-12 and by[3, b["red"]] == 1.0


def test_chunks_of_a_batch_of_long_texts_go_out_in_small_batches():
    import pyarrow as pa

    texts = ["ab cd\n" * 100_000, None, "", "x" * 3_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(texts)], ["doc_id", "text"])
    out = list(CH.chunk_batches(iter([batch]), ["doc_id", "chunk_pos", "char_start", "n_chars", "chunk"], 1024, 128))
    assert max(sum(b.column(3).to_pylist()) for b in out) < CH.CHARS_OUT + 1024
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert rows == [(i, pos, a, b - a, t[a:b]) for i, t in zip([1, 2, 3, 4], texts) for pos, (a, b) in enumerate(CH.cut_places(t or ""))]


def test_text_vectors_take_few_rows_at_a_time():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * postings.BLOCK_ROWS + 1))], ["a"])
    parts = list(postings._parts(iter([batch])))
    assert [p.num_rows for p in parts] == [postings.BLOCK_ROWS, postings.BLOCK_ROWS, 1]


def test_text_vectors_by_hand(spark):
    import math

    texts = [(1, "Red red blue"), (2, "blue"), (3, None), (4, ""), (5, "green blue")]
    got = {(r["id"], r["bucket"]): r["weight"] for r in postings.text_vectors(
        spark.createDataFrame(texts, "id INT, t STRING"), ["id"], "t").collect()}
    b = {w: postings.bucket_of(w, postings.FEATURES) for w in ("red", "blue", "green")}
    idf = {w: math.log(6 / (n + 1)) for w, n in (("red", 1), ("blue", 3), ("green", 1))}
    norm1, norm5 = math.hypot(2 * idf["red"], idf["blue"]), math.hypot(idf["green"], idf["blue"])
    want = {(1, b["red"]): 2 * idf["red"] / norm1, (1, b["blue"]): idf["blue"] / norm1, (2, b["blue"]): 1.0,
            (5, b["green"]): idf["green"] / norm5, (5, b["blue"]): idf["blue"] / norm5}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_windows_of_a_long_text_are_cut_in_an_arrow_pass(spark):
    """Column expressions would scan a text from its start for each of its windows."""
    texts = [(1, "aé" * 50_000, "en"), (2, "", "en"), (3, None, None), (None, "x" * 1025, "de"), (4, "y" * 128, "fr")]
    chunks = CH.fixed_chunks(spark.createDataFrame(texts, "doc_id BIGINT, text STRING, lang STRING"), carry=["lang"])
    assert "MapInArrow" in chunks._jdf.queryExecution().toString()
    want = []
    for i, t, lang in texts:
        if t is None:
            want.append((i, lang, 0, 0, None, None))
        for k in range(0 if not t else max(1, -(-(len(t) - 128) // 896))):
            part = t[k * 896:k * 896 + 1024]
            want.append((i, lang, k, k * 896, len(part), part))
    def order(r):
        return (r[0] or 0, r[2])

    assert sorted(map(tuple, chunks.collect()), key=order) == sorted(want, key=order)
