import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import catalog as C
from tessera.operators import schedule as S

H = 24


def _feasible(h, d, blocked, check):
    end = h + d - 1
    if end > H - 1:
        return False
    if check == "ends":
        return h not in blocked and end not in blocked
    return not any(h <= b <= end for b in blocked)


def _brute_occupancy(products, blocked, check):
    best = 0

    def rec(h, total):
        nonlocal best
        best = max(best, total)
        for t in range(h, H):
            for d, b in products:
                if _feasible(t, d, blocked, check):
                    rec(t + d, total + b)

    rec(0, 0)
    return best


def _brute_window(products, blocked, check):
    feas = {}
    for h in range(H):
        ds = [d for d, _ in products if _feasible(h, d, blocked, check)]
        if ds:
            feas[h] = (max(ds), max(b for d, b in products if _feasible(h, d, blocked, check)))
    windows = [(h, h + L - 1) for h, (L, _) in feas.items()]
    hours = sorted(feas)
    best = 0

    def ok(chosen):
        return all(sum(1 for c in chosen if s <= c <= e) <= 1 for s, e in windows)

    def rec(i, chosen, total):
        nonlocal best
        best = max(best, total)
        for j in range(i, len(hours)):
            nxt = chosen + [hours[j]]
            if ok(nxt):
                rec(j + 1, nxt, total + feas[hours[j]][1])

    rec(0, [], 0)
    return best


def _catalog(spark, groups):
    rows = []
    pid = 0
    for g, prods in groups.items():
        for d, b in prods:
            rows.append((g, pid, float(d) - 0.5, b))
            pid += 1
    return spark.createDataFrame(rows, "collection STRING, id BIGINT, duration DOUBLE, benefit BIGINT")


@pytest.mark.parametrize("check", ["ends", "all"])
def test_values_match_brute_force(spark, check):
    rng = random.Random(11 if check == "ends" else 12)
    groups, blocked = {}, sorted(rng.sample(range(H), 5))
    for g in range(6):
        groups[f"g{g}"] = [(rng.randint(6, 13), rng.randint(1, 50)) for _ in range(rng.randint(1, 3))]
    cat = _catalog(spark, groups)
    occ = {r["collection"]: r["value"] for r in S.best_value(cat, "collection", 2, 1, blocked, check).collect()}
    win = {r["collection"]: r["value"] for r in
           S.best_value(cat, "collection", 1, 1, blocked, check, mode="window").collect()}
    for g, prods in groups.items():
        assert occ[g] == 2 * _brute_occupancy(prods, set(blocked), check)
        assert win[g] == _brute_window(prods, set(blocked), check)


@pytest.mark.parametrize("check", ["ends", "all"])
def test_window_plan_keeps_the_rule_and_the_total(spark, check):
    rng = random.Random(21)
    groups, blocked = {}, sorted(rng.sample(range(H), 5))
    for g in range(8):
        groups[f"g{g}"] = [(rng.randint(2, 13), rng.randint(1, 50)) for _ in range(rng.randint(1, 4))]
    groups["none"] = [(24, 5)]  # blocked hours at its ends: no run
    cat = _catalog(spark, groups)
    plan = S.best_plan(cat, "collection", 2, 1, blocked, check, mode="window").collect()
    value = {r["collection"]: r["value"] for r in S.best_value(cat, "collection", 2, 1, blocked, check, mode="window").collect()}
    product = {r["id"]: r for r in cat.collect()}
    for g, prods in groups.items():
        runs = sorted((r["start"], r["finish"], r["id"]) for r in plan if r["collection"] == g and r["slot"] == 1)
        assert sum(product[r["id"]]["benefit"] for r in plan if r["collection"] == g) == value[g]
        feas = [(h, h + d - 1) for d, _ in prods for h in range(H) if _feasible(h, d, set(blocked), check)]
        for s, e in feas:  # at most one start of any product in the window of every feasible run
            assert sum(s <= r[0] <= e for r in runs) <= 1
        assert all((s, e) in feas and e - s + 1 == -(-product[i]["duration"] // 1) for s, e, i in runs)
    assert any(r["collection"] != "none" for r in plan)
    with pytest.raises(ValueError):
        S.best_plan(cat, "collection", mode="other")


def test_plan_is_valid_and_optimal(spark):
    groups = {"a": [(5, 10), (8, 17), (3, 4)], "b": [(24, 99)], "c": [(7, 1), (7, 3)]}
    blocked = [2, 11]
    cat = _catalog(spark, groups)
    plan = S.best_plan(cat, "collection", 1, 1, blocked).collect()
    value = {r["collection"]: r["value"] for r in S.best_value(cat, "collection", 1, 1, blocked).collect()}
    bmap = {r["id"]: r["benefit"] for r in cat.collect()}
    for g in groups:
        runs = sorted((r["start"], r["finish"], r["id"]) for r in plan if r["collection"] == g)
        assert sum(bmap[i] for _, _, i in runs) == value[g]
        for (s1, f1, _), (s2, _, _) in zip(runs, runs[1:]):
            assert f1 < s2
        for s, f, _ in runs:
            assert s not in blocked and f not in blocked and f <= 23


def test_conflict_counts_match_pairs(spark):
    groups = {"a": [(5, 10), (8, 17), (3, 4)], "b": [(2, 1)]}
    cat = _catalog(spark, groups)
    cand = S.candidates(cat, "collection", 1, 1, [4]).collect()
    got = {(r["id"], r["hour"]): r["n_conflicts"] for r in S.conflict_counts(cat, "collection", 1, [4]).collect()}
    for a in cand:
        exp = sum(1 for b in cand if b["collection"] == a["collection"] and a["hour"] <= b["hour"] <= a["finish"])
        assert got[(a["id"], a["hour"])] == exp


def test_validation_and_catalog_clean(spark):
    with pytest.raises(ValueError):
        S.validate(0, 1)
    with pytest.raises(ValueError):
        S.validate(1, 0)
    raw = spark.createDataFrame(
        [("K", "T1", 10, "41XP", "x3", 50, 0.5, None), ("K", "T2", 10, "5XP", "x7", 40, 2.0, None),
         ("L", "T3", 1, "1XP", "x1", 9, 12.0, None)],
        "Collection STRING, Title STRING, `Price (Coins)` BIGINT, `Experience (XP)` STRING, Units STRING, "
        "`Total Revenue (Coins)` BIGINT, `Time (Hrs)` DOUBLE, `Order` STRING")
    clean = C.clean_catalog(raw, ["title"]).orderBy("id").collect()
    assert [(r["title"], r["id"], r["benefit"]) for r in clean] == [("T2", 0, 30), ("T3", 1, 8)]
    xp = raw.select(C.numeric_suffix("Experience (XP)").alias("xp")).collect()
    assert [r["xp"] for r in xp] == [41, 5, 1]


def test_catalog_csv_source(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text(
        "Collection,Title,Price (Coins),Experience (XP),Units,Total Revenue (Coins),Time (Hrs),Order\n"
        "Winter,Woollen Scarf,45,8XP,x2,180,6,\n"
        "Winter,Felt Mittens,30,4XP,x1,95,0.25,\n"
        "Garden,Straw Hat,120,15XP,x9,410,24,\n")
    from tessera.sources import read_catalog_csv
    raw = read_catalog_csv(spark, str(path))
    clean = C.clean_catalog(raw.withColumn("pos", F.monotonically_increasing_id()), ["pos"]).orderBy("id").collect()
    assert [(r["title"], r["benefit"], r["id"]) for r in clean] == [("Woollen Scarf", 135, 0), ("Straw Hat", 290, 1)]
    assert set(clean[0].asDict()) >= {"collection", "title", "cost", "xp", "units", "revenue", "duration", "order"}
    val = S.best_value(C.clean_catalog(raw, ["title"]), "collection", 1, 1, [], mode="occupancy").collect()
    assert {r["collection"]: r["value"] for r in val} == {"Winter": 540, "Garden": 290}
