"""Line dedup, near-dedup of texts and vectors, and the pipeline."""

import random

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tessera.llm import embeddings, line_dedup, near_dedup
from tessera.llm.queries import ORACLE_SQL, QUERIES

import __spark_entry__ as E

from .conftest import MESSY, SCHEMA, prose

SF = "/root/testdata/sf0.001"


def brute_lines(docs, min_words, max_lines):
    """First occurrences by (id, line); docs: list of (id, text) with distinct ids."""
    seen, out = {}, {}
    marks = {i: set() for i, _ in docs}
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        lines = (text or "").split("\n")
        for s in range(len(lines)):
            total = 0
            for k in range(max_lines):
                if s + k >= len(lines):
                    break
                total += len([w for w in lines[s + k].strip(" ").split(" ")]) if lines[s + k].strip(" ") else 0
                if total >= min_words or k == max_lines - 1:
                    key = tuple(lines[s:s + k + 1])
                    if key in seen:
                        marks[i] |= set(range(s, s + k + 1))
                    else:
                        seen[key] = (i, s)
                    break
    for i, text in docs:
        lines = (text or "").split("\n")
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in marks[i]), len(marks[i]))
    return out


@pytest.mark.parametrize("min_words,max_lines", [(6, 3), (50, 4), (1, 1), (1000, 2)])
def test_line_dedup_equals_brute_force(spark, min_words, max_lines):
    rng = random.Random(min_words)
    lines = [prose(k, rng.randint(1, 5)) for k in range(12)] + ["", " ", "same", "same"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14)))) for i in range(60)] + [(None, "same\nsame\nsame\nsame"), (99, None)]
    got = {r.doc_id: (r.deduped or "", r.n_removed) for r in line_dedup.dedup_lines(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), min_words, max_lines).collect()}
    assert got == brute_lines(docs, min_words, max_lines)


def test_line_dedup_messy(messy, empty):
    out = line_dedup.dedup_lines(messy)
    assert out.count() == len(MESSY) and line_dedup.dedup_lines(empty).count() == 0
    # both rows of id 2 are one document: the earlier text of id 1 removes them alike
    assert {r.n_removed for r in out.where("doc_id = 2").collect()} == {1}
    assert out.where("doc_id = 3").first().deduped is None
    assert out.where("doc_id = 6").first().n_removed > 20  # repeats within one document


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    order = list(want.columns)
    assert got.sort_values(order).values.tolist() == want.sort_values(order).values.tolist()


def copies():
    rng = random.Random(11)
    docs, k = [], 0
    for base in range(12):
        words = prose(500 + base, rng.randint(30, 200)).split()
        for _ in range(rng.randint(1, 8)):
            new = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                new[rng.randrange(len(new))] = "changed" + str(rng.randrange(99))
            docs.append((k, " ".join(new)))
            k += 1
    return docs + [(k, "short one"), (k + 1, "short one"), (k + 2, "short two"), (k + 3, "a b a b a b a b a b a b"), (k + 4, "a b a b a b a b a b")]


def components(ids, pairs):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def weighted_jaccard(texts, idf):
    parts = [dict(zip(*(x.tolist() for x in near_dedup.elements(near_dedup.word_hashes(t), idf)), strict=True)) for t in texts]
    w = lambda p, keys: sum(2.0 ** (p[k] / 4) for k in keys)
    out = np.zeros((len(texts), len(texts)))
    for i, p in enumerate(parts):
        for j, q in enumerate(parts):
            common = w(p, p.keys() & q.keys())
            out[i, j] = common / (w(p, p) + w(q, q) - common)
    return out


def weights_of(docs):
    hashes = [np.unique(near_dedup.word_hashes(t or "")) for _, t in docs]
    return near_dedup.Weights(*np.unique(np.concatenate(hashes), return_counts=True), len(docs))


@pytest.mark.parametrize("block", [256, 3])
def test_near_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", block)
    monkeypatch.setattr(near_dedup, "FAMILY_BLOCK", block)
    docs = copies()
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    idf = weights_of(docs)
    s = weighted_jaccard([t for _, t in docs], idf)
    off = ~np.eye(len(docs), dtype=bool)  # a text isn't compared with itself
    assert np.allclose(s[off], near_dedup.similarities([t for _, t in docs], idf)[off])
    want = components([i for i, _ in docs], [(i, j) for i in range(len(docs)) for j in range(i) if s[i, j] >= 0.8])
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame).collect()}
    assert got == want and len(set(want.values())) < len(want)


@pytest.mark.parametrize("chunk", [3 << 20, 2000, 1])
def test_near_dedup_weighs_each_word_by_its_own_count(spark, monkeypatch, chunk):
    docs = copies() + [(1000, None), (1001, "")]
    sets = [set((t or "").split()) for _, t in docs]
    df = {w: sum(w in s for s in sets) for w in set().union(*sets)}
    idf = {w: np.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items()}

    def weighed(text):  # (shingle, occurrence) -> weight
        words, out, seen = text.split(), {}, {}
        k = min(5, len(words))
        for s in range(len(words) - k + 1 if words else 0):
            shingle = tuple(words[s:s + k])
            seen[shingle] = seen.get(shingle, 0) + 1
            out[shingle, seen[shingle]] = 2.0 ** (np.clip(np.rint(4 * np.log2(sum(idf[w] for w in shingle) / k)), 0, 31) / 4)
        return out

    parts = [weighed(t or "") for _, t in docs]
    close = []
    for i, p in enumerate(parts):
        for j, q in enumerate(parts[:i]):
            common = sum(p[x] for x in p.keys() & q.keys())
            if common and common / (sum(p.values()) + sum(q.values()) - common) >= 0.8:
                close.append((docs[i][0], docs[j][0]))
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", chunk)
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    words = sorted(df)
    assert np.allclose(weights_of(docs).of(near_dedup.word_hashes(" ".join([*words, "unmet"]))), [*(idf[w] for w in words), np.log((1 + len(docs)) / 2) + 1])
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame).collect()}
    assert got == components([i for i, _ in docs], close)


def test_an_id_with_several_texts_stands_for_each(spark):
    a, b = prose(71, 150), prose(72, 150)
    near = lambda t: " ".join("changed" if k == 40 else w for k, w in enumerate(t.split()))
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, prose(73, 150))]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_samples_agree_as_often_as_texts_are_alike():
    idf = near_dedup.Weights(np.empty(0, np.uint64), np.empty(0, np.int64), 1)  # every word weighs one
    rng = random.Random(2)
    sampler, words = near_dedup.Sampler(1024), [f"w{k}" for k in range(400)]
    for changes in (0, 5, 20, 60):
        new = list(words)
        for k in rng.sample(range(400), changes):
            new[k] = "other"
        a, b = (near_dedup.elements(near_dedup.word_hashes(" ".join(x)), idf) for x in (words, new))
        same = np.mean(np.frombuffer(sampler.signature(*a), "<u4") == np.frombuffer(sampler.signature(*b), "<u4"))
        true = near_dedup.similarities([" ".join(words), " ".join(new)], idf)[0, 1]
        assert abs(same - true) < 0.08


def test_near_dedup_messy(messy, empty):
    out = near_dedup.near_duplicates(messy).collect()
    assert len(out) == len(MESSY) and near_dedup.near_duplicates(empty).count() == 0
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.class_id, r.kept))
    assert by[2] == {(1, False)} and by[1] == {(1, True)} and by[3] == {(3, True)} and by[4] == {(4, True)}
    assert by[None] == {(None, True)}


@pytest.mark.parametrize("block", [256, 7])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "LEAF", 16)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(900):
        base = rng.standard_normal(24) if k % 3 or not rows else np.array(rows[rng.integers(len(rows))][1]) * rng.choice([1.0, 2.0])
        if k % 5 == 0:
            base = base + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.12, 0.2])
        rows.append((k, [float(x) for x in base], int(k % 4)))
    odd = [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, rows[5][1], None),
           (2004, [None] + rows[5][1][1:], 1), (2005, [], 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (None, rows[5][1], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT").withColumn("rep", F.lit("x"))
    v = embeddings.unit(np.array([r[1] for r in rows]))
    label = np.array([r[2] for r in rows])
    close = (v @ v.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    parts = components(range(900), zip(*np.nonzero(np.triu(close))))
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    found = sum(got[k].n_links for k in range(900))
    assert found >= 0.99 * close.sum() and all(got[k].n_links <= close[k].sum() for k in range(900))
    assert sum(got[k].component_id == parts[k] for k in range(900)) >= 890
    for k in (2000, 2001, 2002, 2003, 2004, 2005):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[2007].component_id == 2006 and not got[None].kept
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_recall_of_the_forest_on_the_given_vectors(spark, monkeypatch):
    """The given vectors and near copies of every third one, in trees that split."""
    monkeypatch.setattr(embeddings, "LEAF", 24)
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    rng = np.random.default_rng(8)
    v, label = np.stack(given["embedding"].to_numpy()).astype(float), given["label"].to_numpy()
    v = np.concatenate([v, v[::3] + rng.standard_normal(v[::3].shape) * np.linalg.norm(v[::3], axis=1)[:, None] * 0.018])
    label = np.concatenate([label, label[::3]])
    frame = spark.createDataFrame([(k, x.tolist(), int(y)) for k, (x, y) in enumerate(zip(v, label, strict=True))],
                                  "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    u = embeddings.unit(v)
    close = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    got = embeddings.near_duplicates(frame).orderBy("vec_id").toPandas()
    assert got["n_links"].sum() >= 0.99 * close.sum() > 500
    assert (got["n_links"].to_numpy() <= close.sum(axis=1)).all()


def test_stages_keep_columns_and_clean_rows(spark, messy, empty, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    messy.write.parquet(str(tmp_path / "documents.parquet"))
    for docs in (messy, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            if docs is messy:  # copies of id 1 may go; everything else stays
                assert {i for i, _ in MESSY} - {2} <= ids, name
    packed = corpus_pipeline.pack(spark, messy, str(tmp_path))
    assert packed.groupBy("doc_id").count().count() == len({i for i, _ in MESSY})


def test_pipeline_stages_take_effect(spark):
    import duckdb
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    after = {r.doc_id for r in clean.collect()}
    assert all(i in after for i, t in labels.items() if t == 0)
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()
    want = brute_lines(list(before.items()), line_dedup.MIN_WORDS, line_dedup.MAX_LINES)
    assert {r.doc_id: r.text for r in lines} == {i: t for i, (t, n) in want.items() if not n or n < before[i].count("\n") + 1}
    assert all(r.n_chars == len(r.text) for r in lines)
    hidden = corpus_pipeline.redact_personal_data(spark, docs, SF).collect()
    from tessera.llm.pii import fixed_spans
    assert all(not fixed_spans(r.text) for r in hidden)
    assert all(r.text == before[r.doc_id] or "<" in r.text for r in hidden)
    run = corpus_pipeline.run(spark, SF)
    assert run.count() > 0 and {"doc_id", "sequence_id", "ids_crc32"} <= set(run.columns)


def test_pipeline_keeps_one_of_copies_that_end_in_short_lines(spark, tmp_path):
    docs, k = [], 0
    for group in range(4):
        text = "\n".join(prose(900 + 10 * group + n, words) for n, words in enumerate([60, 22, 93, 2 + group]))
        for _ in range(3):
            docs.append((k, text))
            k += 1
    docs += [(100, None), (101, ""), (102, ""), (103, " \n "), (None, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    stages = dict(corpus_pipeline.STAGES)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    cut = corpus_pipeline.write_table(stages["line_dedup"](spark, frame, str(tmp_path)))
    left = stages["minhash_near_dedup"](spark, cut, str(tmp_path)).collect()
    ids = sorted(r.doc_id for r in left if r.doc_id is not None)
    assert [i for i in ids if i >= 3] == [3, 6, 9, 100, 101, 102, 103]
    assert [i for i in ids if i < 3] == [0]  # cut after the null id, which is first, but none of its copies
    assert {r.doc_id: r.text for r in left}[3] == docs[3][1]


def test_pipeline_leaves_no_near_copy_that_the_line_stage_cut(spark, tmp_path):
    """Near copies of several lines: their common lines are cut, and what is left resembles nothing."""
    rng = random.Random(31)
    docs = []
    for group in range(6):
        lines = [prose(3000 + 10 * group + n, 60).split() for n in range(6)]
        for copy in range(3):
            mine = [list(x) for x in lines]
            if copy:  # four words of one line are changed
                for k in range(10, 14):
                    mine[copy][k] = f"other{group}x{copy}x{k}"
            docs.append((10 * group + copy, "\n".join(" ".join(x) for x in mine)))
    docs += [(900 + k, prose(4000 + k, 80)) for k in range(5)]
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    cut = stages["line_dedup"](spark, frame, str(tmp_path))
    assert cut.count() == len(docs)  # no whole copies, and each copy keeps its changed line
    left = stages["minhash_near_dedup"](spark, corpus_pipeline.write_table(cut), str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == [10 * g for g in range(6)] + [900 + k for k in range(5)]


def test_registered():
    names = {n.split("_")[0] for n in E.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "pii", "best_fit_packing"]
    assert SCHEMA and pd.__version__


def test_tables_of_texts_and_words_go_as_soon_as_they_are_used(spark):
    """They stayed on disk beside the tables of the steps behind them."""
    import glob

    from tessera.session import ensure_checkpoint_dir

    def tables():
        return set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/tables/*"))

    rows = [(k, " ".join(f"w{k % 5}x{j}" for j in range(60)) + (" more" if k > 6 else "")) for k in range(12)]
    before = tables()
    result = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2))
    left = [set(spark.read.parquet(t).columns) for t in tables() - before]
    assert left and not [c for c in left if c & {"text", "chunk", "bucket"}]
    assert sorted((r.doc_id, r.class_id) for r in result.collect()) == [(k, k % 5) for k in range(12)]


def odd_texts():
    rng = random.Random(4)
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    marks = ["a", "b", "é", "中", "‐", "ᚁ", "​", "\U0001f642", "aa", *spaces, *[" "] * 12]
    return [["".join(rng.choice(marks) for _ in range(rng.choice([0, 3, 20, 200]))) for _ in range(rng.randint(0, 12))] for _ in range(200)]


def test_words_of_a_chunk_are_those_of_each_text():
    for texts in odd_texts():
        hashes, numbers, held = near_dedup.hashed_words(texts)
        each = [near_dedup.word_hashes(t) for t in texts]
        assert held.tolist() == list(map(len, each)) and (np.diff(hashes.astype(float)) >= 0).all()
        assert hashes[numbers].tolist() == [h for e in each for h in e.tolist()]


def test_elements_of_a_chunk_are_those_of_each_text():
    for texts in odd_texts():
        hashes, numbers, held = near_dedup.hashed_words(texts)
        own = 1 + np.arange(len(hashes)) % 7 / 3
        shingles, level, sizes = near_dedup.elements_of(hashes[numbers], own[numbers], held)
        stops = np.cumsum(sizes)
        for k, t in enumerate(texts):
            mine = slice(stops[k] - sizes[k], stops[k])
            words, seen, want = t.split(), {}, {}
            m = min(5, len(words))
            h = near_dedup.word_hashes(t)
            for s in range(len(words) - m + 1 if words else 0):
                key = 0
                for w in h[s:s + m].tolist():
                    key = (key * int(near_dedup.STEP) + w) % 2 ** 64
                key = int(near_dedup._mix(np.array([(key + m) % 2 ** 64], np.uint64))[0])
                weight = sum(own[np.searchsorted(hashes, h[s:s + m])]) / m
                turn = seen[key] = seen.get(key, -1) + 1
                if turn:
                    key = int(near_dedup._mix(np.array([(key + turn * int(near_dedup.STEP)) % 2 ** 64], np.uint64))[0])
                want[key] = np.clip(np.rint(4 * np.log2(weight)), 0, 31)
            assert dict(zip(shingles[mine].tolist(), level[mine].tolist(), strict=True)) == want
            assert shingles[mine].tolist() == sorted(want)


def test_a_worker_draws_one_table_of_samples():
    """A table was drawn for every chunk, and every group of candidates became a pandas frame."""
    assert near_dedup.sampler() is near_dedup.sampler()
    plan = near_dedup.near_duplicates.__code__.co_names
    assert "applyInArrow" in plan and "applyInPandas" not in plan
