"""Periodic runs against brute force over every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import __spark_entry__ as E
import numpy as np
import pytest
from tessera.llm import periodic_runs as runs

from .conftest import MESSY

SF = "/root/testdata/sf0.001"


def brute(s, least=24, times=3):
    """Every stretch of equal words p apart, unless a smaller period holds there too."""
    n, out = len(s), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if s[i] != s[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            if j + p - i >= max(least, times * p) and not any(s[i:j + p - q] == s[i + q:j + p] for q in range(1, p)):
                out.append((i, j + p - i, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def shaped(rng, n, letters):
    s = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        a, p = rng.randrange(max(n, 1)), rng.randint(1, 12)
        for i in range(a + p, min(n, a + rng.randint(1, 70))):
            s[i] = s[i - p]
    return s


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (10, 3), (24, 4)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least * times)
    for _ in range(300):
        texts = [shaped(rng, rng.randint(0, 130), rng.choice([1, 2, 2, 3, 5, 200])) for _ in range(3)]
        want = [brute(s, least, times) for s in texts]
        assert [runs.runs_of(s, least, times) for s in texts] == want
        assert runs._search([[str(w).encode() for w in s] for s in texts], least, times) == want


def test_nested_runs_and_long_texts():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    got = runs.runs_of(b)
    assert got == brute(b) and len(got) > 50  # a Fibonacci word: runs inside runs
    rng = random.Random(5)
    base = [rng.randrange(10 ** 6) for _ in range(4000)]
    assert runs.runs_of([base[i % 4000] for i in range(30_000)]) == [(0, 30_000, 4000)]
    assert runs.runs_of([7] * 50_000) == [(0, 50_000, 1)]


def test_colours_are_the_last_ends():
    """The colour of a state's path is where its longest string ended last."""
    rng = random.Random(3)
    s = [rng.randrange(3) for _ in range(60)]
    tree = runs.LinkTree()
    for i, w in enumerate(s):
        tree.append(w)
        want = set()
        for p in range(1, (i + 1) // 2 + 1):
            if s[i - 2 * p + 1:i - p + 1] == s[i - p + 1:i + 1] and not any(
                    all(s[k] == s[k - q] for k in range(i - 2 * p + 1 + q, i + 1)) for q in range(1, p)):
                want.add(p)
        assert set(tree.access(i)) == want  # the periods of the primitive squares that end here


def test_stretches_lose_no_run():
    rng = random.Random(9)
    for _ in range(200):
        s = shaped(rng, 200, 40)
        kept = runs.stretches(np.array(s), np.zeros(len(s), np.int64), 24, 3)
        assert all(any(a <= b and b + n <= e for a, e in kept) for b, n, _ in brute(s))
    assert runs.window(24, 3) == 9 and runs.window(24, 2) == 1
    with pytest.raises(ValueError):
        runs.window(24, 1)


def words_of(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len((text or "").encode().split())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def wanted(doc_id, text):
    words = words_of(doc_id, text)
    found = brute(words)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()), sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r) for r in E.queries()["op11_link_cut_runs"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    short = {i: t for i, t in docs.items() if len(t or "") < 40_000}
    assert got.keys() == docs.keys() and len(short) > 150
    assert {i: got[i] for i in short} == {i: wanted(i, t) for i, t in short.items()}
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_messy(spark, messy, empty):
    clashing = messy.withColumnRenamed("n", "runs")  # then other names are given
    out = runs.find_runs(clashing, names=("r1", "r2", "r3"))
    assert out.columns == [*clashing.columns, "r1", "r2", "r3"] and out.count() == len(MESSY)
    found = runs.find_runs(messy)
    assert found.count() == len(MESSY) and runs.find_runs(empty).count() == 0
    by = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    assert by[3].collapsed is None and by[3].runs == [] and by[4].collapsed == "" and by[5].collapsed == ""
    assert by[9].runs == [(0, 5000, 1)] and by[9].collapsed == "word" and by[6].strongest == (0, 30, 1)
    signs = [(1, "a\x1fb\x85c d\xa0 e\x0bf\x0cg"), (2, "x y")]
    frame = runs.find_runs(spark.createDataFrame(signs, "doc_id BIGINT, text STRING"))
    assert [r.collapsed for r in frame.orderBy("doc_id").collect()] == ["a\x1fb\x85c d\xa0 e f g", "x y"]
