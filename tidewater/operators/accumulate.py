"""Mergeable accumulators: create, add, merge, result, as an aggregate function of a window has them.

An :class:`Accumulator` is four column functions on a state. :func:`accumulate` runs it in two phases: the rows of a block of a key
are added one by one to a new state, then the states merge in a tree, at most ``fan`` at a time. With an ``order`` the rows
are added and the states merged along it (merge need not commute); with ``spread_by`` the rows of a key are dealt to blocks by
a hash of those columns, and merge must commute. Either way a key that holds a third of the rows has many blocks, and a
block holds about ``width`` rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.blocks import BLOCK, ROW, fold_tree, numbered
from tidewater.operators.running import BROADCAST_KEYS, _null_safe
from tidewater.session import materialize

BLOCK_ROWS, FAN = 4096, 64


@dataclass(frozen=True)
class Accumulator:
    """``kind`` is the state's type; ``add`` gets the state and a struct of the row's columns."""

    kind: str
    create: Callable[[], Column]
    add: Callable[[Column, Column], Column]
    merge: Callable[[Column, Column], Column]
    result: Callable[[Column], Column] = lambda s: s


def _dealt(df: DataFrame, keys: list[str], spread_by: list[str], width: int) -> DataFrame:
    """``df`` plus a block per row: keys of more than ``width`` rows are dealt to as many blocks as they need."""
    large = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tw_n")).where(F.col("_tw_n") > width))
    n = large.count()
    if n == 0:
        return df.withColumn(BLOCK, F.lit(0).cast("long"))
    marked = _null_safe(df, F.broadcast(large) if n <= BROADCAST_KEYS else large, keys, "left")
    deal = F.pmod(F.xxhash64(*spread_by), F.ceil(F.col("_tw_n") / width))
    return marked.withColumn(BLOCK, F.coalesce(deal, F.lit(0)).cast("long")).drop("_tw_n")


def accumulate(df: DataFrame, keys: list[str], acc: Accumulator, out: str, *, order: str | None = None, spread_by: list[str] | None = None,
               width: int = BLOCK_ROWS, fan: int = FAN, **split) -> DataFrame:
    """One row per key: (keys, ``out``)."""
    if (order is None) == (spread_by is None):
        raise ValueError("give either order or spread_by")
    values = [c for c in df.columns if c not in keys]
    if order is not None:
        rows, at = numbered(df, keys, order, width, **split), F.col(ROW)
    else:
        rows, at = _dealt(df, keys, spread_by, width), F.lit(0)
    row = F.struct(at.alias("at"), F.struct(*values).alias("row"))
    held = rows.groupBy(*keys, BLOCK).agg(F.collect_list(row).alias("_rows"))
    if order is not None:
        held = held.withColumn("_rows", F.array_sort("_rows", lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0)))
    state = F.aggregate("_rows", acc.create().cast(acc.kind), lambda s, x: acc.add(s, x["row"]).cast(acc.kind))
    states = held.select(*keys, BLOCK, state.alias("_state"))
    done = fold_tree(states, keys, BLOCK, "_state", acc.merge, fan)
    return done.select(*keys, acc.result(F.col("_state")).alias(out))


def longest_gap_of(time: str) -> Accumulator:
    """First and last time, largest distance of neighbours, rows. Times are numbers in ascending order; rows without a
    time count as rows only."""
    def add(s, x):
        t = x[time]
        return F.struct(F.coalesce(s["first"], t), F.coalesce(t, s["last"]), F.greatest(s["gap"], t - s["last"]), s["rows"] + 1)

    def merge(a, b):
        return F.struct(F.coalesce(a["first"], b["first"]), F.coalesce(b["last"], a["last"]),
                        F.greatest(a["gap"], b["gap"], b["first"] - a["last"]), a["rows"] + b["rows"])

    none = F.lit(None).cast("long")
    return Accumulator("struct<first:bigint,last:bigint,gap:bigint,rows:bigint>",
                       lambda: F.struct(none.alias("first"), none.alias("last"), none.alias("gap"), F.lit(0).cast("long").alias("rows")), add, merge)


def best_of(k: int, item: str, before: Callable[[Column, Column], Column]) -> Accumulator:
    """The ``k`` best items as a bounded priority list, best first. ``item`` is the type of the row's struct; ``before(a, b)`` says
    whether item a ranks before item b. An item is put behind those that rank before it and the last one beyond ``k`` falls
    out, so no state has more than ``k`` items, and nothing is sorted. If ``before`` is a total order, merge commutes."""
    def put(s, x):
        ahead = F.filter(s, lambda i: before(i, x))
        behind = F.filter(s, lambda i: ~before(i, x))
        return F.slice(F.concat(ahead, F.array(x), behind), 1, k)

    kind = f"array<{item}>"
    return Accumulator(kind, lambda: F.array(), put, lambda a, b: F.aggregate(b, a, lambda s, x: put(s, x).cast(kind)))
