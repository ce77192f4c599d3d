"""Manifest: roots, proofs and checks against a plain re-computation."""

import hashlib
import zlib

import __spark_entry__ as E
import duckdb
import pytest
from pyspark.sql import functions as F
from tessera.llm import manifest

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def up(nodes):
    return [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, owners = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        levels = [[leaf(*r) for r in mine]]
        while len(levels[-1]) > 1:
            levels.append(up(levels[-1]))
        trees.append(levels)
        owners.append(mine)
    top = [[t[-1][0] for t in trees]]
    while len(top[-1]) > 1:
        top.append(up(top[-1]))
    out = []
    for t, (levels, mine) in enumerate(zip(trees, owners, strict=True)):
        for i, r in enumerate(mine):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]) if bad else r[4]
            node, proof = leaf(*r[:4], text), []
            for tree, at in ((levels, i), (top, t)):
                for level in tree[:-1]:
                    run = level[at // 8 * 8:at // 8 * 8 + 8]
                    before, behind = run[:at % 8], run[at % 8 + 1:]
                    proof += before + behind
                    node, at = H(*before, node, *behind), at // 8
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], H(*proof), node, node == top[-1][0]))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(frame):
    out = manifest.manifest(frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    assert out.columns == COLUMNS
    return sorted(map(repr, map(tuple, out.collect())))


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9}, {"a": 64, "b": 65, None: 8, "é": 1, "": 600}, {f"l{k}": k + 1 for k in range(11)}])
def test_manifest_equals_brute_force(spark, sizes):
    rows, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            k += 7
            rows.append((k * 31 % 5003, None if k % 5 == 0 else f"s{k % 3}", lang, None if k % 11 == 0 else k, None if k % 13 == 0 else f"Text É {k}\n" * (k % 4)))
    frame = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING").repartition(5)
    assert run(frame) == sorted(map(repr, brute(rows)))


def test_manifest_messy(spark, messy, empty):
    """Null ids, equal rows, nulls everywhere, clashing columns; and no rows."""
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in messy.collect()]
    assert run(messy) == sorted(map(repr, brute(rows)))
    copies = [(1, "s", "en", 3, "ABC")] * 70 + [(2, "s", "en", 3, "ABC")] * 3
    frame = spark.createDataFrame(copies, "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING")
    assert run(frame) == sorted(map(repr, brute(copies)))
    assert run(empty) == []


def test_manifest_equals_sql_and_stays_on_the_jvm(spark):
    df = E.queries()["op13_merkle_manifest"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    res = con.execute(E.oracle_sql()["op13_merkle_manifest"])
    columns = [d[0] for d in res.description]
    assert columns == df.columns
    got = sorted(map(repr, map(tuple, df.collect())))
    assert got == sorted(map(repr, res.fetchall())) and any(x.endswith("False)") for x in got)
    assert "Python" not in df._jdf.queryExecution().toString() and "MapInArrow" not in df._jdf.queryExecution().toString()
