"""Running reduce by any associative function (``keyBy(k).reduce(f)``, one result per row).

``f`` is given as column functions on a state: ``lift`` makes the state of one row, ``combine(earlier, later)`` joins two
neighbouring stretches of rows, ``result`` reads the value off a state. ``combine`` must be associative; it need not
commute. The states of all prefixes come from a parallel prefix scan (:mod:`tidewater.operators.blocks`), so a key
that holds a third of the rows is cut into blocks of ``width`` rows, and everything stays in built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.blocks import BLOCK, ROW, numbered, prefix_scan

STATE = "_tw_state"
#: rows of a block: a scan takes log2 of it steps, or fewer if no key has as many rows
SCAN_WIDTH = 1024


def running_reduce(df: DataFrame, keys: list[str], order: str, lift: Column, combine: Callable[[Column, Column], Column],
                   result: Callable[[Column], Column], out: str, width: int = SCAN_WIDTH, **split) -> DataFrame:
    """``df`` plus the column ``out``: the reduction of the rows of the key up to this one, along ``order``.

    ``lift`` is a struct that is never null. ``split`` goes to :func:`numbered` (chunk_width, hot_threshold)."""
    rows = numbered(df, keys, order, width, **split).withColumn(STATE, lift)
    done = prefix_scan(rows, keys, STATE, combine, width)
    return done.withColumn(out, result(F.col(STATE))).drop(ROW, BLOCK, STATE)


#: room for sums of money with nine places: two of them add up without losing a place
AMOUNT = "decimal(36,9)"


def clamped_add(amount: Column, low, high) -> Column:
    """The state of "add ``amount``, then keep within low and high": the function x -> min(hi, max(lo, x + a)).

    Functions of this form are closed under composition, which :func:`then` is. A null amount adds nothing."""
    return F.struct(F.coalesce(amount.cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("a"), F.lit(low).cast(AMOUNT).alias("lo"),
                    F.lit(high).cast(AMOUNT).alias("hi"))


def then(f: Column, g: Column) -> Column:
    """g after f, for two states of :func:`clamped_add`."""
    def within(x):
        return F.least(g["hi"], F.greatest(g["lo"], x.cast(AMOUNT)))

    return F.struct((f["a"] + g["a"]).alias("a"), within(f["lo"] + g["a"]).alias("lo"), within(f["hi"] + g["a"]).alias("hi"))


def applied_to_zero(f: Column) -> Column:
    return F.least(f["hi"], F.greatest(f["lo"], f["a"]))
