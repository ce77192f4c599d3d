import random
from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import OFFERS
from tessera.operators import bundles as B
from tessera.sources import read_offer_csv


def _menu(spark, rows, group=0):
    return spark.createDataFrame([(group, a, c) for a, c in rows], "group_id BIGINT, amount INT, price_cents BIGINT")


def _brute(offers, n):
    """All multisets summing to n; lexicographic (cents, orders, sorted amounts)."""
    amounts = sorted(offers)
    best = None

    def rec(i, left, chosen, cents):
        nonlocal best
        if left == 0:
            cand = (cents, len(chosen), sorted(chosen))
            if best is None or cand < best:
                best = cand
            return
        for j in range(i, len(amounts)):
            a = amounts[j]
            if a <= left:
                rec(j, left - a, chosen + [a], cents + offers[a])

    rec(0, n, [], 0)
    return best


def test_offer_csv_golden(spark, tmp_path):
    path = tmp_path / "offers.csv"
    path.write_text("amount,price\n" + "\n".join(f"{a},{p}" for a, p in OFFERS) + "\n")
    offers = read_offer_csv(spark, str(path))
    best = B.best_bundles(offers, "group_id", 199, with_bundle=True).where(F.col("n") >= 4)
    rows = {r["n"]: r for r in best.collect()}
    assert len(rows) == 196 and all(r["feasible"] for r in rows.values())
    assert sum(r["best_cents"] for r in rows.values()) == 2217635
    assert rows[29]["best_cents"] == 3235 and rows[29]["orders"] == 1
    assert rows[100]["best_cents"] == 11120 and rows[100]["bundle"] == [50, 50]
    assert rows[199]["best_cents"] == 22180 and rows[199]["bundle"] == [6, 18, 50, 125]
    all_rows = {r["n"]: r for r in B.best_bundles(offers, "group_id", 10).collect()}
    assert [n for n in (1, 2, 3) if not all_rows[n]["feasible"]] == [1, 2, 3]
    assert all_rows[1]["best_cents"] is None
    minima = B.unit_price_minima(best, "group_id").collect()
    assert sorted(r["n"] for r in minima) == [25, 50, 75, 100, 125, 150, 175]
    assert all(abs(r["unit_price"] - 1.112) < 1e-12 for r in minima)
    assert [r["n"] for r in minima if r["first"]] == [25]
    beaten = B.beaten_offers(offers, "group_id", 199).collect()
    assert sorted(r["amount"] for r in beaten) == [24, 60, 75, 90, 100, 150]


def test_best_bundles_match_brute_force(spark):
    rng = random.Random(7)
    menus = []
    for g in range(12):
        amounts = rng.sample(range(1, 9), rng.randint(1, 4))
        menus.append({a: rng.randint(50, 900) for a in amounts})
    df = spark.createDataFrame([(g, a, c) for g, m in enumerate(menus) for a, c in m.items()],
                               "group_id BIGINT, amount INT, price_cents BIGINT")
    got = {(r["group_id"], r["n"]): r for r in B.best_bundles(df, "group_id", 14, with_bundle=True).collect()}
    for g, m in enumerate(menus):
        for n in range(1, 15):
            exp = _brute(m, n)
            r = got[(g, n)]
            if exp is None:
                assert not r["feasible"] and r["best_cents"] is None
            else:
                assert (r["best_cents"], r["orders"], r["bundle"]) == (exp[0], exp[1], exp[2])
                assert sum(r["bundle"]) == n


def test_bundle_mix_counts(spark):
    df = _menu(spark, [(2, 150), (3, 200)])
    best = B.best_bundles(df, "group_id", 7, with_bundle=True)
    mix = {(r["n"], r["amount"]): r["times"] for r in B.bundle_mix(best, "group_id").collect()}
    assert mix[(7, 2)] == 2 and mix[(7, 3)] == 1
    assert (1, 2) not in mix


def test_offers_from_lines_prefilters(spark):
    lines = spark.createDataFrame([(1, 2.0, 10.0), (1, 2.0, 8.5), (1, 60.0, 1.0)], "k BIGINT, q DOUBLE, p DOUBLE")
    rows = B.offers_from_lines(lines, "k", "q", "p", 50).collect()
    assert [(r["amount"], r["price_cents"]) for r in rows] == [(2, 850)]
    assert Decimal("8.50") * 100 == 850


def test_menus_are_solved_in_array_passes(spark):
    """No interpreted fold is left in the plan; prices beyond 64 bits of scaled cents stay exact."""
    huge = 10**17
    df = _menu(spark, [(2, huge), (2, huge + 5), (3, huge + 1), (4, None)]).unionByName(_menu(spark, [(5, None)], group=1))
    best = B.best_bundles(df, "group_id", 8, with_bundle=True)
    plan = best._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "aggregate(sequence" not in plan
    rows = {(r["group_id"], r["n"]): r for r in best.collect()}
    assert len(rows) == 16 and not any(r["feasible"] for (g, _), r in rows.items() if g == 1)
    for n in range(1, 9):
        want = _brute({2: huge, 3: huge + 1}, n)
        got = rows[0, n]
        assert (got["best_cents"], got["orders"], got["bundle"]) == (want or (None, None, None))
