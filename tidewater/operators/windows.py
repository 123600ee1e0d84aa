"""Time and count windows over keyed rows.

Time windows (tumbling, sliding, day with offset) are Spark's ``window``
expression inside ``groupBy``: each row is assigned to its window(s) in the
projection and the aggregate is partial + final, so hot keys are combined
before the shuffle.

Session windows and count windows need the order of rows within a key. They
are built on :func:`tidewater.operators.running.running_aggregate`, so a key
that holds a large share of the data is split into ordered chunks instead of
being sorted by a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money
from tidewater.functions.timefn import epoch_micros, from_epoch_micros
from tidewater.session import materialize
from tidewater.operators.running import (CHUNK_COLUMN, DEFAULT_HOT_THRESHOLD, RunningSpec, row_chunk,
                                         running_aggregate, with_chunks)

_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def duration_micros(text: str) -> int:
    """``'5 hours'`` -> microseconds (units: second, minute, hour, day)."""
    n, unit = text.split()
    unit = unit.rstrip("s")
    return int(n) * _MICROS[unit]


def _money_aggs(value: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.sum(exact_money(value)).cast("double").alias("sum_value"),
    ]


def _flatten(df: DataFrame, keys: list[str], wcol: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != wcol]
    return df.select(*keys, F.col(f"{wcol}.start").alias("window_start"),
                     F.col(f"{wcol}.end").alias("window_end"), *rest)


def tumbling(df: DataFrame, keys: list[str], ts: str, size: str, value: str,
             start_time: str | None = None) -> DataFrame:
    """Tumbling event-time windows: ``(keys, window_start, window_end, event_count, sum_value)``."""
    w = F.window(ts, size, size, start_time) if start_time else F.window(ts, size)
    return _flatten(df.groupBy(*keys, w.alias("window")).agg(*_money_aggs(value)), keys)


def sliding(df: DataFrame, keys: list[str], ts: str, size: str, slide: str, value: str) -> DataFrame:
    """Sliding windows: each row lands in ``size / slide`` windows (Spark expands it)."""
    return _flatten(df.groupBy(*keys, F.window(ts, size, slide).alias("window")).agg(*_money_aggs(value)), keys)


def day_windows(df: DataFrame, keys: list[str], ts: str, value: str, offset: str) -> DataFrame:
    """Calendar days of a zone east of UTC: ``offset`` is the UTC hour a day starts at
    (a −8 h window offset is a 16 h start time; both give the same buckets)."""
    return tumbling(df, keys, ts, "1 day", value, start_time=offset)


def session_windows(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap: str,
    value: str,
    tie: str,
    chunk: str = "1 minute",
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """Session windows: a new session starts when the previous row of the key is
    more than ``gap`` earlier (rows exactly ``gap`` apart merge, as touching
    sessions do). Output: ``(keys, window_start, window_end, event_count, sum_value)``
    with ``window_end = last row + gap``.

    Two chunked running passes (previous timestamp, then session number) keep
    a hot key spread over many tasks; the final ``groupBy`` is partial + final.
    """
    gap_us = duration_micros(gap)
    us = "_tw_us"
    d = df.withColumn(us, epoch_micros(ts))
    order = [F.col(us), F.col(tie)]
    # hot keys are found once; both passes share the chunk column
    d, split = with_chunks(d, keys, row_chunk(us, duration_micros(chunk)), hot_threshold)
    chunk_col = F.col(CHUNK_COLUMN)
    d = running_aggregate(d, keys=keys, order=order, chunk=chunk_col, chunked=split,
                          specs=[RunningSpec("_tw_prev", "max", us, exclusive=True)])
    d = d.withColumn("_tw_new", F.when(F.col("_tw_prev").isNull() | (F.col(us) - F.col("_tw_prev") > gap_us), 1)
                     .otherwise(0))
    d = d.select(*keys, us, tie, value, CHUNK_COLUMN, "_tw_new")
    if split:       # the second pass reads this frame in two branches: compute it once
        d = materialize(d)
    d = running_aggregate(d, keys=keys, order=order, chunk=chunk_col, chunked=split,
                          specs=[RunningSpec("_tw_sid", "sum", "_tw_new")])
    g = d.groupBy(*keys, "_tw_sid").agg(
        F.min(us).alias("_s"), F.max(us).alias("_e"), *_money_aggs(value))
    return g.select(*keys, from_epoch_micros("_s").alias("window_start"),
                    from_epoch_micros(F.col("_e") + F.lit(gap_us)).alias("window_end"),
                    "event_count", "sum_value")


def count_windows(
    df: DataFrame,
    keys: list[str],
    order: str,
    size: int,
    slide: int,
    value: str,
    chunk_width: int = 1 << 16,
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """Count windows per key: fire at every ``slide``-th row of a key with the
    aggregate of its last ``size`` rows (``size == slide``: tumbling, the
    unfinished rest never fires).

    Row ``n`` (1-based within the key) belongs to the windows ending at the
    multiples ``e`` of ``slide`` with ``n <= e <= n + size - 1``: at most
    ``ceil(size / slide)`` copies per row, grouped by ``(key, e)`` with partial
    aggregation. A window fires only if its end row ``e`` exists.
    Output: ``(keys, window_index, event_count, sum_value, last_<order>)``.
    """
    d = running_aggregate(df, keys=keys, order=[order], chunk=row_chunk(order, chunk_width),
                          specs=[RunningSpec("_tw_n", "count")], hot_threshold=hot_threshold)
    first_k = F.ceil(F.col("_tw_n") / F.lit(slide))
    last_k = F.floor((F.col("_tw_n") + F.lit(size - 1)) / F.lit(slide))
    # a row in no window (slide > size) gets an empty list; sequence() would count down
    ids = F.when(first_k <= last_k, F.sequence(first_k.cast("long"), last_k.cast("long"))) \
        .otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("window_index", F.explode(ids))
    g = d.groupBy(*keys, "window_index").agg(
        F.max("_tw_n").alias("_tw_last_n"),
        F.max(order).alias(f"last_{order}"),
        *_money_aggs(value),
    )
    return g.where(F.col("_tw_last_n") == F.col("window_index") * F.lit(slide)).select(
        *keys, "window_index", "event_count", "sum_value", f"last_{order}")
