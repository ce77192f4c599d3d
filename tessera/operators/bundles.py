"""Exact-quantity bundles: the cheapest multiset of offers that sums to a target.

Each group (a menu: one part, one shop, ...) is solved independently by an unbounded
knapsack recurrence, evaluated for many groups at once by array operations in an Arrow pass:

    best(0) = (0 cents, 0 orders)
    best(n) = min over offers a <= n of (best(n - a).cents + price(a), best(n - a).orders + 1)

The minimum is lexicographic on ``(cents, orders)``: cheapest first, then fewest orders
at that price (the two-phase objective of the original as a single ordered struct).
Money is integer cents, so ties are exact.

Scale: offers are pre-aggregated to one row per ``(group, amount)`` (map-side partial
aggregation, so a hot group shrinks before the shuffle) and amounts above the largest
target are dropped before collection, so each collected menu is bounded by
``max_target`` entries no matter how many source rows a group has.  A task solves ``CELLS``
cells (groups x targets) at a time, whatever the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.session import ship_package

#: Targets times groups that are solved at once.
CELLS = 1 << 19


def offers_from_lines(lines: DataFrame, group_col: str, amount_col: str, price_col: str,
                      max_target: int) -> DataFrame:
    """Menu ``(group, amount, price_cents)``: lowest price seen for each quantity.

    The ``amount <= max_target`` filter is pushed into the scan; larger offers can never
    be part of an exact bundle for a smaller target.  A fractional quantity is no offer.
    """
    return (
        lines.where(F.col(amount_col) <= max_target)
        .where(F.col(amount_col) >= 1)
        .where(F.col(amount_col) == F.floor(F.col(amount_col)))
        .groupBy(F.col(group_col), F.col(amount_col).cast("int").alias("amount"))
        .agg(F.min(F.round(F.col(price_col) * 100).cast("bigint")).alias("price_cents"))
    )


def _solve(groups: int, group: np.ndarray, amount: np.ndarray, cents: np.ndarray, max_target: int) -> tuple[np.ndarray, ...]:
    """(cents, orders, feasible, first) of every target and group, as arrays of ``max_target`` + 1
    rows.  ``first`` is the smallest amount that some best bundle holds.

    Cents and orders are one number, cents * (max_target + 1) + orders, so that a comparison is
    lexicographic; where that doesn't fit 64 bits, Python's integers take over."""
    scale = max_target + 1
    bound = (max(map(abs, (int(cents.max()), int(cents.min()))), default=0) + 1) * max_target * scale if len(cents) else scale
    never = 4 * bound  # a sum with it stays above 2 * bound
    kind = np.int64 if bound < 1 << 59 else object
    price = np.full((scale, groups), never, kind)
    np.minimum.at(price, (amount, group), cents.astype(kind) * scale + 1)
    offered = np.unique(amount).tolist()
    best = np.full((scale, groups), never, kind)
    best[0] = 0
    first = np.zeros((scale, groups), np.int32)
    for n in range(1, scale):
        for a in offered:
            if a > n:
                break
            cost = best[n - a] + price[a]
            less = cost < best[n]
            best[n][less] = cost[less]
            first[n][less] = a
        best[n][best[n] > 2 * bound] = never
    feasible = best < never
    return np.where(feasible, best // scale, 0), np.where(feasible, best % scale, 0), feasible, first


def _bundle_lists(orders: np.ndarray, first: np.ndarray) -> pa.Array:
    """The lexicographically smallest sorted best bundle of every group and target.

    It starts with the smallest amount that some best bundle holds, and its rest is the smallest
    best bundle for what is left; all of them are walked at once, an amount a step."""
    targets, groups = orders.shape
    lengths = orders.T.ravel()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    amounts = np.empty(offsets[-1], np.int32)
    group, left = np.divmod(np.arange(targets * groups), targets)
    at, open_ = offsets[:-1].copy(), np.flatnonzero(lengths)
    while len(open_):
        a = first[left[open_], group[open_]]
        amounts[at[open_]] = a
        left[open_] -= a
        at[open_] += 1
        open_ = open_[left[open_] > 0]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(amounts))


def solve_menus(offers: DataFrame, group_cols: Sequence[str] | str, max_target: int,
                with_bundle: bool = False) -> DataFrame:
    """One row per group: its menu ``offers`` and the solved table ``best`` where
    ``best[n]`` is the optimum for target ``n`` (index 0 is the empty bundle)."""
    if max_target < 1:
        raise ValueError("max_target must be >= 1")
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    menus = (
        offers.where(F.col("amount").between(1, max_target))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("amount", "price_cents")).alias("offers"))
    )
    entry = [T.StructField("c", T.LongType()), T.StructField("o", T.IntegerType())]
    if with_bundle:
        entry.append(T.StructField("b", T.ArrayType(T.IntegerType())))
    schema = T.StructType([*menus.schema, T.StructField("best", T.ArrayType(T.StructType(entry)))])
    size = max(1, CELLS // (max_target + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, size) for at in range(0, batch.num_rows, size)):
                menu = part.column(len(keys))
                amount, cents = menu.flatten().flatten()
                priced = pc.is_valid(cents)  # an offer without a price is none
                group = np.repeat(np.arange(part.num_rows), menu.value_lengths().to_numpy())[priced.to_numpy(zero_copy_only=False)]
                amount = amount.filter(priced).cast(pa.int32()).to_numpy()
                cents = cents.filter(priced).cast(pa.int64()).to_numpy()
                c, o, feasible, first = _solve(part.num_rows, group, amount, cents, max_target)
                fields = [pa.array(c.T.ravel(), pa.int64()), pa.array(o.T.ravel().astype(np.int32))]
                if with_bundle:
                    fields.append(_bundle_lists(o.astype(np.int64), first))
                entries = pa.StructArray.from_arrays(fields, names=[f.name for f in entry], mask=pa.array(~feasible.T.ravel()))
                offsets = pa.array(np.arange(part.num_rows + 1) * (max_target + 1), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, entries)], names=schema.names)

    ship_package(offers.sparkSession)
    return menus.mapInArrow(run, schema)


def best_bundles(offers: DataFrame, group_cols: Sequence[str] | str, max_target: int,
                 with_bundle: bool = False) -> DataFrame:
    """Best bundle for every target ``n`` in ``1..max_target`` of every group.

    Output ``(*group_cols, n, best_cents, orders, feasible[, bundle])``.  Infeasible
    targets stay as rows with null price and ``feasible = false``.  ``bundle`` is the
    sorted list of offer amounts; among equal (price, orders) the lexicographically
    smallest sorted list wins, which the recurrence preserves exactly.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    # ``best`` always holds index 0, so the outer form returns the same rows.
    solved = solve_menus(offers, keys, max_target, with_bundle).select(
        *keys, F.posexplode_outer("best").alias("n", "best"))
    cols = [
        *keys,
        F.col("n"),
        F.col("best.c").alias("best_cents"),
        F.col("best.o").alias("orders"),
        F.col("best.c").isNotNull().alias("feasible"),
    ]
    if with_bundle:
        cols.append(F.col("best.b").alias("bundle"))
    return solved.where(F.col("n") >= 1).select(*cols)


def beaten_offers(offers: DataFrame, group_cols: Sequence[str] | str, max_target: int) -> DataFrame:
    """Offers that a combination of other offers undercuts (``best(amount) < price``).

    Read off the solved table in the same row as the menu: no join, no second scan.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    solved = solve_menus(offers, keys, max_target)
    beaten = F.filter("offers", lambda o: F.col("best")[o["amount"]]["c"] < o["price_cents"])
    return (
        solved.select(*keys, "best", F.explode(beaten).alias("o"))
        .select(*keys, F.col("o.amount").alias("amount"), F.col("o.price_cents").alias("price_cents"),
                F.col("best")[F.col("o.amount")]["c"].alias("best_cents"),
                F.col("best")[F.col("o.amount")]["o"].alias("orders"))
        .withColumn("saving_cents", F.col("price_cents") - F.col("best_cents"))
    )


def unit_price_minima(best: DataFrame, group_cols: Sequence[str] | str) -> DataFrame:
    """Every target reaching the group's lowest price per unit; ``first`` marks the smallest.

    The unit price is one double division of integers, identical for equal rationals,
    so ``rank() = 1`` finds every argmin exactly.  The window is per group and a group
    holds at most ``max_target`` rows.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    unit = (F.col("best_cents").cast("double") / (F.col("n") * 100).cast("double"))
    w = Window.partitionBy(*keys).orderBy(F.col("unit_price"))
    w_first = Window.partitionBy(*keys).orderBy(F.col("n"))
    return (
        best.where(F.col("feasible"))
        .select(*keys, "n", "best_cents", unit.alias("unit_price"))
        .withColumn("rk", F.rank().over(w))
        .where(F.col("rk") == 1)
        .withColumn("first", F.row_number().over(w_first) == 1)
        .drop("rk")
    )


def bundle_mix(best_with_bundle: DataFrame, group_cols: Sequence[str] | str) -> DataFrame:
    """Multiplicity of each offer inside each best bundle: ``(*group, n, amount, times)``.

    Counted inside each row from the bundle list (no shuffle); the number of rows per
    ``(group, n)`` is the number of distinct offers combined.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    counts = F.transform(F.array_distinct("bundle"),
                         lambda a: F.struct(a.alias("amount"),
                                            F.size(F.filter("bundle", lambda x: x == a)).cast("bigint").alias("times")))
    return (
        best_with_bundle.where(F.col("feasible"))
        .select(*keys, "n", F.inline(counts))
    )
