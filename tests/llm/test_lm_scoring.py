"""Language-model scores against a plain dictionary model."""

import math
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter

import __spark_entry__ as E
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tessera.llm import lm_scoring as lm

from .conftest import MESSY

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]


class Plain:
    """The same model by its formula: dictionaries of counts and a recursion."""

    def __init__(self, texts, order, mu):
        self.order, self.mu, self.counts = order, mu, Counter()
        for t in texts:
            words = ["<s>", *tokens(t)]
            self.counts["<s>",] += 1
            for i in range(1, len(words)):
                for m in range(1, min(order, i + 1) + 1):
                    self.counts[tuple(words[i - m + 1:i + 1])] += 1
        single = {g: c for g, c in self.counts.items() if len(g) == 1 and g != ("<s>",)}
        self.n, self.v = sum(single.values()), len(single)

    def p(self, gram):
        if len(gram) == 1:
            return (self.counts.get(gram, 0) + 1) / (self.n + self.v + 1)
        below, context = self.p(gram[1:]), self.counts.get(gram[:-1], 0)
        return (self.counts.get(gram, 0) + self.mu * below) / (context + self.mu) if context else below

    def row(self, text):
        words = ["<s>", *tokens(text)]
        known = sum((w,) in self.counts for w in words[1:])
        base = sum(math.log10(self.p((w,))) for w in words[1:])
        score = sum(math.log10(self.p(tuple(words[max(0, i - self.order + 1):i + 1]))) for i in range(1, len(words)))
        return len(words) - 1, known, self.n, base, score


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def HELD():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def check(got, rows, order, mu):
    model = Plain([t for i, t in rows if not held(i)], order, mu)
    want = sorted((repr((i, held(i))), *model.row(t)) for i, t in rows)
    have = sorted((repr((r[0], r[1])), *r[2:]) for r in got)
    assert [w[:4] for w in want] == [h[:4] for h in have]
    for w, h in zip(want, have, strict=True):
        assert h[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9), w[0]


def speech(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("The cat sat on a mat and the dog ran to it".split()) for _ in range(n))


@pytest.mark.parametrize("order,chunk_bytes", [(1, 1 << 20), (2, 1 << 20), (2, 300), (3, 300), (4, 2000)])
def test_scores_equal_the_formula(spark, order, chunk_bytes):
    rows = [(k, speech(k // 2, 3 + k % 40)) for k in range(120)] + [(500, None), (501, ""), (502, "never Seen words Here"), (3, speech(1, 5))]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    check(lm.score_documents(frame, HELD(), order=order, mu=2.5, chunk_bytes=chunk_bytes).collect(), rows, order, 2.5)


def test_query_equals_the_formula(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = E.queries()["op12_backoff_automaton"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(out.collect(), rows, lm.ORDER, lm.MU)


def test_messy(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert len(rows) == len(MESSY)
    check(lm.score_documents(messy, HELD()).collect(), rows, lm.ORDER, lm.MU)
    assert lm.score_documents(empty, HELD()).count() == 0
    untrained = lm.score_documents(spark.createDataFrame([(1, "a b")], "doc_id BIGINT, text STRING"), F.lit(True)).first()
    assert tuple(untrained)[1:] == (True, 3, 0, 0, 0.0, 0.0)
    with pytest.raises(ValueError):
        lm.score_documents(messy, HELD(), order=0)


def test_chances_after_every_context_sum_to_one():
    texts = [speech(k, 30).encode() for k in range(8)]
    grams = lm.Grams(texts, np.ones(8, bool), 3)
    n, v = int(grams.trained[1].sum()) - 8, int((grams.trained[1] > 0).sum()) - 1
    machine = lm.Automaton(grams, grams.trained, n, v, 3.0)
    for state in range(len(machine.fail)):
        total = 0.0
        for w in range(1, machine.wide):  # every word but the start of texts
            at, lost = state, 0.0
            while at and at * machine.wide + w not in machine.arcs:
                lost += machine.fail_weight[at]
                at = machine.fail[at]
            total += 10 ** (lost + (machine.weight[machine.arcs[at * machine.wide + w]] if at else machine.base[w]))
        lost, at = 0.0, state  # and all unknown words together
        while at:
            lost += machine.fail_weight[at]
            at = machine.fail[at]
        assert total + 10 ** lost / (n + v + 1) == pytest.approx(1.0)


def test_requests_round_trip():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2 ** 63, 50).astype(np.uint64) * np.uint64(2)
    assert (lm.from_planes(lm.planes(x)) == x).all() and len(lm.from_planes(lm.planes(x[:0]))) == 0
    names = [c.split()[0] for c in lm.REQUEST.split(", ")]
    grams = [lm.Grams([speech(k, 50).encode()], np.array([k != 1]), 2) for k in range(3)]
    for m in (1, 2):
        rows = [dict(zip(names, r, strict=True)) for c, g in enumerate(grams) for r in lm.requests(g, c, 5) if r[2] == m]
        for b in range(5):
            mine = [r for r in rows if r["bucket"] == b]
            if mine:
                totals, _, _ = lm.add_up(mine)
                for r, t in zip(mine, totals, strict=True):
                    keys = np.cumsum(lm.from_planes(r["keys"]), dtype=np.uint64)
                    want = [sum(int(g.trained[m][g.keys[m] == k].sum()) for g in grams) for k in keys]
                    assert t.tolist() == want


def walk(machine, ids):
    """The traversal of one text, step by step."""
    at, total = machine.next_empty[0], 0.0  # the state of the start of a text
    for w in ids:
        while at and at * machine.wide + w not in machine.arcs:
            total += machine.fail_weight[at]
            at = machine.fail[at]
        if at:
            arc = machine.arcs[at * machine.wide + w]
            total += machine.weight[arc]
            at = machine.next[arc]
        else:
            total += machine.base[w]
            at = machine.next_empty[w]
    return total


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_moves_by_array_passes_equal_steps(order):
    rng = random.Random(order)
    texts = [speech(k, rng.randint(0, 60)).encode() for k in range(40)] + [b"", b" \n", b"never Seen words Here", "é\x85b\x1cc".encode() * 3]
    for share in (0, 0.5, 1):
        grams = lm.Grams(texts, np.array([rng.random() < share for _ in texts]), order)
        n, v = int(grams.trained[1][1:].sum()), int((grams.trained[1][1:] > 0).sum())
        machine = lm.Automaton(grams, grams.trained, n, v, 3.0)
        ids = [grams.at[1][a:b].tolist() for a, b in zip(grams.starts + 1, grams.ends, strict=True)]
        assert machine.traverse(grams).tolist() == [walk(machine, x) for x in ids]


def test_words_are_cut_as_bytes_split():
    rng = random.Random(1)
    for _ in range(200):
        texts = ["".join(rng.choice("aAbBÉé \t\n\r\x0b\x0c\x1c\x85\xa0\x00") for _ in range(rng.randint(0, 25))).encode()
                 for _ in range(rng.randint(0, 8))]
        split = [t.lower().split() for t in texts]
        words, numbers, held = lm.cut_words(texts)
        assert words == list(dict.fromkeys(w for x in split for w in x))
        assert [words[k] for k in numbers] == [w for x in split for w in x] and held.tolist() == [len(x) for x in split]


def test_scoring_a_chunk_runs_no_python_step_a_token():
    """Lines of Python run while a chunk is cut, joined to its counts and traversed, however many tokens it has."""
    def lines(words):
        texts = [speech(k, words).encode() for k in range(20)]
        ran = 0

        def trace(frame, event, _):
            nonlocal ran
            ran += event in ("line", "call")
            return trace

        sys.settrace(trace)
        try:
            grams = lm.Grams(texts, np.ones(20, bool), 2)
            lm.Automaton(grams, grams.trained, 20 * words, 15, 3.0).traverse(grams)
        finally:
            sys.settrace(None)
        return ran

    assert lines(2000) < 2 * lines(200)


def test_numbers_travel_in_as_few_planes_as_they_need():
    rng = np.random.default_rng(3)
    for bits in (1, 7, 8, 9, 31, 48, 63, 64):
        for n in (0, 1, 2, 300):
            x = rng.integers(0, 2 ** bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 2 ** 64 - 1, n, dtype=np.uint64)
            x[:1] = 2 ** 64 - 1
            assert lm.from_planes(lm.planes(x)).tolist() == x.tolist()
            assert len(lm.planes(x)) <= 9 + -(-bits // 8) * n  # 8 a number before
    assert lm.from_planes(lm.planes(np.zeros(5, np.int64))).tolist() == [0] * 5


def test_owners_get_equal_shares(spark):
    """Hashed bucket numbers gave an owner up to three times the mean, and one task's memory grew with that."""
    asked = spark.range(0, 2 * 51 * 5).select((F.col("id") % 102).cast("int").alias("bucket"))
    held = lm.to_owners(asked, 51).groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("bucket").alias("b"), F.count("*").alias("n"))
    assert sorted(tuple(r)[1:] for r in held.collect()) == [(2, 10)] * 51


def test_adding_up_holds_no_more_than_a_bucket_beside_the_requests():
    names = [c.split()[0] for c in lm.REQUEST.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    rng, n, buckets = np.random.default_rng(4), 20_000, 16
    rows = []
    for chunk in range(4):
        for b in range(buckets):
            keys = np.sort(rng.integers(b << 60, (b + 1 << 60) - 1, n, dtype=np.uint64))
            rows.append((b, chunk, 2, n, lm.planes(np.diff(keys, prepend=np.uint64(0))), None, lm.planes(rng.integers(0, 9, n))))
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    raw = batch.nbytes
    assert raw < 10 * n * len(rows)  # 16 bytes each before
    tracemalloc.start()
    try:
        got = lm.by_bucket(iter([batch]), "ord")
        assert sorted(got) == [(b, 2) for b in range(buckets)]
        tracemalloc.reset_peak()
        while got:
            lm.add_up(got.popitem()[1])
        assert tracemalloc.get_traced_memory()[1] < 2 * raw  # 7 times before
    finally:
        tracemalloc.stop()
