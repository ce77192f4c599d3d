"""Calendar scheduling: choose products and start hours that maximise total benefit.

A product of ``d = ceil(duration)`` hours started at hour ``h`` occupies ``h..h+d-1`` of
one slot.  A start is feasible when it ends inside the horizon and the run's ends
(``check='ends'``, the original rule) or all its hours (``check='all'``) avoid the
blocked hours.

Exact solutions come from dynamic programs per group (collection), not from a generic
integer-programming solver:

* ``mode='occupancy'``: runs in a slot must not overlap.  Only durations matter for
  feasibility, so each group is first reduced to the best product per duration (a
  dominance prune, at most 24 x days rows), then ``V(h) = max(V(h+1), b_d + V(h+d))``
  is folded from the last hour down.
* ``mode='window'``: the literal constraint of the original model -- for every feasible
  (product, start) at most one start of any product falls in that product's window.
  With ``L(h)`` the longest feasible run at ``h`` and ``R(h) = max_{h'<=h} h'+L(h')-1``
  consecutive chosen starts must satisfy ``t2 > R(t1)``, so
  ``V(h) = max(V(h+1), B(h) + V(R(h)+1))``.

Slots never interact in either model, so ``slots`` parallel slots are worth ``slots``
times one slot.  Every group is one row carrying arrays bounded by the horizon, so a
hot collection costs no more than a small one after the prune.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



HOURS_PER_DAY = 24


def validate(slots: int, days: int) -> None:
    if slots < 1:
        raise ValueError("slots must be >= 1")
    if days < 1:
        raise ValueError("days must be >= 1")


def _blocked_sql(blocked: Sequence[int]) -> str:
    vals = sorted({int(h) for h in blocked})
    return f"cast(array({', '.join(str(v) for v in vals)}) as array<int>)"


def _feasible_sql(h: str, d: str, horizon: int, blocked: Sequence[int], check: str) -> str:
    """SQL predicate: a run of ``d`` hours can start at ``h``."""
    bl = _blocked_sql(blocked)
    end = f"({h} + {d} - 1)"
    if check == "ends":
        avail = f"not array_contains({bl}, {h}) and not array_contains({bl}, {end})"
    elif check == "all":
        avail = f"not exists({bl}, z -> z >= {h} and z <= {end})"
    else:
        raise ValueError("check must be 'ends' or 'all'")
    return f"({end} <= {horizon - 1} and {avail})"


def feasible_start(hour: Column, hours: Column, horizon: int, blocked: Sequence[int],
                   check: str = "ends") -> Column:
    """Boolean column for a (start hour, duration hours) pair."""
    end = hour + hours - 1
    bl = F.array(*[F.lit(int(b)) for b in sorted(set(blocked))]).cast("array<int>")
    if check == "ends":
        ok = ~F.array_contains(bl, hour) & ~F.array_contains(bl, end)
    elif check == "all":
        ok = ~F.exists(bl, lambda z: (z >= hour) & (z <= end))
    else:
        raise ValueError("check must be 'ends' or 'all'")
    return (end <= horizon - 1) & ok


def candidates(catalog: DataFrame, group_col: str, slots: int = 1, days: int = 1,
               blocked: Sequence[int] = (), check: str = "ends") -> DataFrame:
    """Every feasible (product, start hour, slot): ``(group, id, hour, finish, slot)``.

    Hours come from ``explode(sequence())`` per product, a generator rather than a join.
    """
    validate(slots, days)
    horizon = HOURS_PER_DAY * days
    d = F.ceil(F.col("duration")).cast("int")
    return (
        catalog.select(F.col(group_col), "id", d.alias("hours"),
                       F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("hour"))
        .where(feasible_start(F.col("hour"), F.col("hours"), horizon, blocked, check))
        .select(group_col, "id", "hour", (F.col("hour") + F.col("hours") - 1).alias("finish"),
                F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot"))
    )


def conflict_counts(catalog: DataFrame, group_col: str, days: int = 1,
                    blocked: Sequence[int] = (), check: str = "ends") -> DataFrame:
    """For every feasible (product, start) in one slot, how many feasible starts of any
    product of the group fall in its window ``start..min(start+d-1, last)`` (itself
    included): the size of each conflict constraint of the original model.

    Counted from per-hour prefix sums, never by materialising the conflicting pairs.
    """
    horizon = HOURS_PER_DAY * days
    cand = candidates(catalog, group_col, 1, days, blocked, check).drop("slot")
    per_hour = cand.groupBy(group_col, "hour").agg(F.count(F.lit(1)).alias("n"))
    prefix = per_hour.groupBy(group_col).agg(
        F.collect_list(F.struct("hour", "n")).alias("cnt")
    ).select(
        group_col,
        F.expr(f"""aggregate(sequence(0, {horizon - 1}), cast(array(0L) as array<bigint>),
                 (acc, h) -> concat(acc, array(acc[h] + coalesce(
                     aggregate(filter(cnt, c -> c.hour = h), 0L, (s, c) -> s + c.n), 0L))))"""
               ).alias("pre"),
    )
    # One small row per group: broadcast if adaptive execution finds it small, so a hot group's candidates
    # are never shuffled into one task.
    return (
        cand.join(prefix, group_col)
        .select(group_col, "id", "hour", "finish",
                (F.expr("pre[finish + 1]") - F.expr("pre[hour]")).alias("n_conflicts"))
    )


def _runs(catalog: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Dominance prune: best product per (group, hours); ties go to the smallest id."""
    d = F.ceil(F.col("duration")).cast("int")
    best = (
        catalog.groupBy(F.col(group_col), d.alias("d"))
        .agg(F.max(F.struct(F.col(value_col).cast("bigint").alias("b"),
                            (-F.col("id")).alias("nid"))).alias("m"))
    )
    return best.groupBy(group_col).agg(
        F.collect_list(F.struct("d", F.col("m.b").alias("b"),
                                (-F.col("m.nid")).alias("id"))).alias("runs"))


#: By hour, the last hour that a feasible run started at or before it can reach.
_REACH = "transform(sequence(0, {last}), h -> array_max(transform(sequence(0, h), k -> k + L[k] - 1)))"


def _reach(runs: DataFrame, columns: list[str], horizon: int, feas: str) -> DataFrame:
    """``columns`` and reach, from L, the longest feasible run at each hour."""
    longest = F.expr(f"transform(sequence(0, {horizon - 1}), h -> array_max(transform(filter(runs, r -> {feas}), r -> r.d)))")
    return runs.withColumn("L", longest).select(*columns, F.expr(_REACH.format(last=horizon - 1)).alias("reach"))


def best_value(catalog: DataFrame, group_col: str, slots: int = 1, days: int = 1,
               blocked: Sequence[int] = (), check: str = "ends", mode: str = "occupancy",
               value_col: str = "benefit") -> DataFrame:
    """Best total value per group: ``(group, slots, value, feasible)``; ``value`` covers
    all slots and ``feasible`` says whether any product can run at all (a status column
    instead of a solver state: an infeasible group has value 0 and ``feasible = false``)."""
    validate(slots, days)
    horizon = HOURS_PER_DAY * days
    feas = _feasible_sql("h", "r.d", horizon, blocked, check)
    runs = _runs(catalog, group_col, value_col)
    feasible = F.expr(f"exists(runs, r -> exists(sequence(0, {horizon - 1}), h -> {feas}))").alias("feasible")
    if mode == "occupancy":
        v0 = F.expr(f"""aggregate(sequence({horizon - 1}, 0, -1), cast(array(0L) as array<bigint>),
            (acc, h) -> concat(array(greatest(acc[0], coalesce(array_max(transform(
                filter(runs, r -> {feas}), r -> r.b + acc[r.d - 1])), acc[0]))), acc))[0]""")
        out = runs.select(group_col, v0.alias("v"), feasible)
    elif mode == "window":
        lb = runs.select(
            group_col, feasible,
            F.expr(f"transform(sequence(0, {horizon - 1}), h -> "
                   f"array_max(transform(filter(runs, r -> {feas}), r -> r.d)))").alias("L"),
            F.expr(f"transform(sequence(0, {horizon - 1}), h -> "
                   f"array_max(transform(filter(runs, r -> {feas}), r -> r.b)))").alias("B"),
        )
        lbr = lb.withColumn("R", F.expr(_REACH.format(last=horizon - 1)))
        v0 = F.expr(f"""aggregate(sequence({horizon - 1}, 0, -1), cast(array(0L) as array<bigint>),
            (acc, h) -> concat(array(case when L[h] is null then acc[0]
                else greatest(acc[0], B[h] + acc[R[h] - h]) end), acc))[0]""")
        out = lbr.select(group_col, v0.alias("v"), "feasible")
    else:
        raise ValueError("mode must be 'occupancy' or 'window'")
    return out.select(group_col, F.lit(slots).alias("slots"),
                      (F.col("v") * slots).cast("bigint").alias("value"), "feasible")


def best_plan(catalog: DataFrame, group_col: str, slots: int = 1, days: int = 1,
              blocked: Sequence[int] = (), check: str = "ends",
              value_col: str = "benefit", mode: str = "occupancy") -> DataFrame:
    """Chosen runs of an optimal schedule, ``(group, slot, start, finish, id)``, under either rule.

    Ties: at each hour starting a run beats waiting (earliest starts), and among equal
    values the smallest product id wins.  Back-pointers are kept in the fold and walked
    forward by a second fold; the next start comes after the run (``occupancy``) or after
    the running maximum of the longest feasible runs' ends (``window``).
    """
    validate(slots, days)
    horizon = HOURS_PER_DAY * days
    feas = _feasible_sql("h", "r.d", horizon, blocked, check)
    runs = _runs(catalog, group_col, value_col)
    if mode == "occupancy":
        after, rest = "h + ch[h].d", "acc[r.d - 1]"
    elif mode == "window":
        after, rest = "reach[h] + 1", "acc[reach[h] - h]"
        runs = _reach(runs, [group_col, "runs"], horizon, feas)
    else:
        raise ValueError("mode must be 'occupancy' or 'window'")
    ch_t = "array<struct<v:bigint,d:int,id:bigint>>"
    best_take = (f"array_max(transform(filter(runs, r -> {feas}), "
                 f"r -> named_struct('v', r.b + {rest}.v, 'nid', -r.id, 'd', r.d)))")
    choice = F.expr(f"""aggregate(sequence({horizon - 1}, 0, -1),
        cast(array(named_struct('v', 0L, 'd', cast(null as int), 'id', cast(null as bigint))) as {ch_t}),
        (acc, h) -> cast(concat(transform(array({best_take}), t ->
            case when t.v >= acc[0].v
                 then named_struct('v', t.v, 'd', t.d, 'id', -t.nid)
                 else named_struct('v', acc[0].v, 'd', cast(null as int), 'id', cast(null as bigint))
            end), acc) as {ch_t}))""")
    walk_t = "struct<nxt:int,picks:array<struct<start:int,d:int,id:bigint>>>"
    walk = F.expr(f"""aggregate(sequence(0, {horizon - 1}),
        cast(named_struct('nxt', 0, 'picks', array()) as {walk_t}),
        (s, h) -> cast(case
            when h = s.nxt and ch[h].d is not null
              then named_struct('nxt', {after},
                   'picks', concat(s.picks, array(named_struct('start', h, 'd', ch[h].d, 'id', ch[h].id))))
            when h = s.nxt then named_struct('nxt', h + 1, 'picks', s.picks)
            else s end as {walk_t})).picks""")
    return (
        runs.withColumn("ch", choice)
        .select(group_col, F.explode(walk).alias("p"))
        .select(group_col, F.col("p.id").alias("id"), F.col("p.start").alias("start"),
                (F.col("p.start") + F.col("p.d") - 1).alias("finish"),
                F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot"))
    )
