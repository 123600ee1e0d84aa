"""An exact row number over a whole table, without a global sort or a window in one task.

The table is cut into stretches of the order column. Rows per stretch are counted by a partial + final aggregate, the counts are
summed up in levels (a level has a ``fan``-th of the rows of the one below, the last one at most ``fan``), and a row's number is the sum before its
stretch plus its place inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAN = 1024


def sums_before(totals: DataFrame, place: str, value: str, out: str, fan: int = FAN) -> DataFrame:
    """``totals`` (one row per place) plus ``out``: the sum of ``value`` over all smaller places."""
    lo, hi = totals.agg(F.min(place), F.max(place)).first()
    if lo is None or hi - lo < fan:
        w = Window.partitionBy(F.lit(0)).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)     # at most fan rows
        return totals.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    upper = f"{place}_up"
    up = totals.withColumn(upper, F.expr(f"({place} - pmod({place}, {fan})) div {fan}"))       # rounds down, as ids may be negative
    sums = sums_before(up.groupBy(upper).agg(F.sum(value).alias("_sum")), upper, "_sum", f"{out}_up", fan)
    w = Window.partitionBy(upper).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    inside = up.withColumn("_in", F.coalesce(F.sum(value).over(w), F.lit(0)))
    both = inside.join(sums.select(upper, f"{out}_up"), upper)
    return both.select(*totals.columns, (F.col(f"{out}_up") + F.col("_in")).alias(out))


def row_index(df: DataFrame, order: str, out: str = "row_index", width: int = 1 << 16, fan: int = FAN) -> DataFrame:
    """``df`` plus ``out`` = 0, 1, ... along the integer column ``order``. Rows without a value come first; rows that share a value are
    numbered in any order, and a stretch of ``width`` values is numbered by one task, so the column should be (nearly) unique."""
    low = df.agg(F.min(order)).first()[0] or 0
    place = F.coalesce(F.expr(f"({order} - {low}) div {width}"), F.lit(-1)).cast("long")
    rows = df.withColumn("_place", place)
    totals = rows.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"))
    first = sums_before(totals, "_place", "_n", "_first", fan).select("_place", "_first")
    w = Window.partitionBy("_place").orderBy(F.col(order).asc_nulls_first())
    inside = rows.withColumn("_in", F.row_number().over(w) - 1)
    return inside.join(first, "_place").withColumn(out, (F.col("_first") + F.col("_in")).cast("long")).drop("_place", "_first", "_in")
