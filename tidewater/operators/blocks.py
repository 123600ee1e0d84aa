"""Rows in blocks of a bounded number of rows, along an order, for work that depends on the order.

A key may hold a third of all rows. :func:`numbered` numbers its rows with the chunked running count of ``running``, and
consecutive numbers make a block: every block but a key's last is full, whatever the values of the order column.
:func:`fold_tree` reduces the ordered states of a key level by level, a bounded number at a time, and :func:`prefix_scan` gives every
state the combination of all before it. No step holds more than one block of a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, row_chunk, running_aggregate
from tidewater.session import materialize

BLOCK, ROW = "_tw_block", "_tw_row"


def numbered(df: DataFrame, keys: list[str], order: str, width: int, chunk_width: int = 1 << 16,
             hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """``df`` plus ``_tw_row`` (0, 1, ... along ``order`` within the key) and ``_tw_block`` = ``_tw_row div width``.

    ``order`` is a numeric column; rows that tie in it, or have none (they come first), are numbered in any order."""
    chunk = F.coalesce(row_chunk(order, chunk_width), F.lit(-(1 << 62)))
    out = running_aggregate(df, keys=keys, order=[F.col(order).asc_nulls_first()], chunk=chunk,
                            specs=[RunningSpec(ROW, "count")], hot_threshold=hot_threshold)
    out = out.withColumn(ROW, F.col(ROW) - 1)
    return out.withColumn(BLOCK, F.expr(f"{ROW} div {width}"))


def on_keys(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the keys of two aliased frames, null equal to null."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def most_rows(rows: DataFrame, keys: list[str]) -> int:
    """Rows of the key with most of them."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def levels_of(most: int, width: int) -> int:
    """How many times ``most`` rows must be merged by ``width`` until one is left."""
    levels = 0
    while most > 1:
        most, levels = -(-most // width), levels + 1
    return levels


def _kind(df: DataFrame, state: str) -> str:
    """The state's type with all its parts nullable, so every combination can be cast to it."""
    return df.schema[state].dataType.simpleString()


def fold_tree(states: DataFrame, keys: list[str], place: str, state: str, merge: Callable[[Column, Column], Column], width: int) -> DataFrame:
    """One row per key: (keys, state), the states merged in the order of ``place``. ``merge`` must be associative; it need
    not commute. At every level a row merges at most ``width`` neighbours."""
    kind = _kind(states, state)
    states = materialize(states)                      # one row per block
    for _ in range(levels_of(most_rows(states, keys), width)):
        rows = states.groupBy(*keys, F.expr(f"{place} div {width}").alias("_up")).agg(
            F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.col(state).alias("s")))).alias("_all"))
        ordered = F.transform("_all", lambda x: x["s"])
        one = F.aggregate(F.slice(ordered, 2, width), ordered[0], lambda a, b: merge(a, b).cast(kind))
        states = rows.select(*keys, F.col("_up").alias(place), one.alias(state))
    return states.select(*keys, state)


def scan_in_blocks(rows: DataFrame, keys: list[str], block: str, place: str, state: str, combine: Callable[[Column, Column], Column],
                   width: int) -> DataFrame:
    """``state`` of every row becomes the combination of its block's states up to it, by doubling steps: after the step of
    distance d a state covers 2 d rows. All steps share one shuffle and one sort."""
    kind = _kind(rows, state)
    w = Window.partitionBy(*keys, block).orderBy(place)
    step = 1
    while step < width:
        before = F.lag(state, step).over(w)
        rows = rows.withColumn("_before", before).withColumn(
            state, F.when(F.col("_before").isNull(), F.col(state)).otherwise(combine(F.col("_before"), F.col(state)).cast(kind))).drop("_before")
        step *= 2
    return rows


def prefix_scan(rows: DataFrame, keys: list[str], state: str, combine: Callable[[Column, Column], Column], width: int) -> DataFrame:
    """``rows`` (with ``_tw_row``, ``_tw_block``) with ``state`` replaced by the combination of all states of the key up to the row.

    Three steps: a scan inside every block; a scan of the block totals, again in blocks (a level has a ``width``-th of the
    rows of the one below); the total of all blocks before is combined from the left. ``combine`` must be associative; it
    need not commute, and states are structs that are never null."""
    kind = _kind(rows, state)
    rows = rows.withColumn(state, F.col(state).cast(kind))
    most = most_rows(rows, keys)
    inside = scan_in_blocks(rows, keys, BLOCK, ROW, state, combine, min(width, most))
    if most <= width:                                 # no key has a second block
        return inside
    inside = materialize(inside)
    totals = (inside.groupBy(*keys, BLOCK).agg(F.max_by(state, ROW).alias(state))
              .withColumnRenamed(BLOCK, ROW).withColumn(BLOCK, F.expr(f"{ROW} div {width}")))
    up = prefix_scan(totals, keys, state, combine, width)
    before = up.select(*keys, (F.col(ROW) + 1).alias(BLOCK), F.col(state).alias("_tw_before"))
    both = inside.alias("l").join(before.alias("r"), on_keys("l", "r", [*keys, BLOCK]), "left")
    whole = F.when(F.col("r._tw_before").isNull(), F.col(f"l.{state}")).otherwise(combine(F.col("r._tw_before"), F.col(f"l.{state}")).cast(kind))
    return both.select(*[F.col(f"l.`{c}`") for c in inside.columns if c != state], whole.alias(state))
