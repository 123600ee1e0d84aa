"""Event-time lateness: which rows a bounded-out-of-order watermark accepts.

For rows in arrival order, the watermark after a row is
``max(ts seen so far) - bound``. A row whose window end is not yet passed by
the watermark is ``on_time``; one that arrives within ``lateness`` after that
is ``late_accepted`` and re-fires the window; later rows are ``late_dropped``
and go to the side output. With ``mx`` the running max of ``ts`` in arrival
order (current row included):

* ``on_time``        if ``mx < window_end + bound``
* ``late_accepted``  if ``mx < window_end + bound + lateness``
* ``late_dropped``   otherwise

The running max has no key (the watermark is global), so it is computed with
chunks of the arrival order: per-chunk maxima, a prefix over the (small)
chunk table, then a window inside each chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money
from tidewater.functions.timefn import epoch_micros, from_epoch_micros
from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, _null_safe, row_chunk, running_aggregate
from tidewater.operators.windows import duration_micros
from tidewater.session import materialize

ON_TIME = "on_time"
LATE_ACCEPTED = "late_accepted"
LATE_DROPPED = "late_dropped"


def classify_lateness(
    df: DataFrame,
    ts: str,
    arrival: str,
    tie: str,
    window: str,
    bound: str,
    lateness: str,
    chunk_width: int = 1 << 20,
) -> DataFrame:
    """Add ``window_start``, ``window_end``, ``watermark_max`` and ``lateness_class``."""
    w_us = duration_micros(window)
    b_us = duration_micros(bound)
    l_us = duration_micros(lateness)
    d = df.withColumn("_tw_us", epoch_micros(ts))
    d = running_aggregate(d, keys=[], order=[F.col(arrival), F.col(tie)], chunk=row_chunk(arrival, chunk_width),
                          specs=[RunningSpec("_tw_mx", "max", "_tw_us")])
    start = F.col("_tw_us") - F.pmod(F.col("_tw_us"), F.lit(w_us))
    d = d.withColumn("_tw_ws", start).withColumn("_tw_we", start + F.lit(w_us))
    cls = (F.when(F.col("_tw_mx") < F.col("_tw_we") + F.lit(b_us), F.lit(ON_TIME))
           .when(F.col("_tw_mx") < F.col("_tw_we") + F.lit(b_us + l_us), F.lit(LATE_ACCEPTED))
           .otherwise(F.lit(LATE_DROPPED)))
    return d.select(
        *df.columns,
        from_epoch_micros("_tw_ws").alias("window_start"),
        from_epoch_micros("_tw_we").alias("window_end"),
        from_epoch_micros("_tw_mx").alias("watermark_max"),
        cls.alias("lateness_class"),
    )


def late_side_output(classified: DataFrame) -> DataFrame:
    """Rows beyond the allowed lateness (the side output)."""
    return classified.where(F.col("lateness_class") == LATE_DROPPED)


def window_firings(
    classified: DataFrame,
    keys: list[str],
    value: str,
    arrival: str,
    tie: str,
    chunk_width: int = 1 << 16,
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """Results a window emits under allowed lateness.

    ``firing = 0``: the on-time result of a key's window (when the watermark
    passes the end, or at end of input). Each accepted late row fires again
    (``firing = 1, 2, ...`` in arrival order) with everything accepted so far.
    Output: ``(keys, window_start, window_end, firing, event_count, sum_value)``.
    """
    wkeys = [*keys, "window_start", "window_end"]
    # on-time and late branches both read the classification (a global pass)
    classified = materialize(classified.select(*wkeys, value, arrival, tie, "lateness_class"))
    on_time = (classified.where(F.col("lateness_class") == ON_TIME)
               .groupBy(*wkeys)
               .agg(F.count(F.lit(1)).alias("_on_n"), F.sum(exact_money(value)).alias("_on_sum")))
    late = classified.where(F.col("lateness_class") == LATE_ACCEPTED).select(*wkeys, value, arrival, tie)
    late = running_aggregate(late, keys=wkeys, order=[F.col(arrival), F.col(tie)],
                             chunk=row_chunk(arrival, chunk_width),
                             specs=[RunningSpec("firing", "count"),
                                    RunningSpec("_late_sum", "sum", exact_money(value))],
                             hot_threshold=hot_threshold)
    refires = _null_safe(late, on_time, wkeys, "left").select(
        *wkeys,
        F.col("firing").cast("long").alias("firing"),
        (F.coalesce(F.col("_on_n"), F.lit(0)) + F.col("firing")).cast("long").alias("event_count"),
        F.coalesce(F.col("_on_sum") + F.col("_late_sum"), "_on_sum", "_late_sum").cast("double").alias("sum_value"),
    )
    first = on_time.select(*wkeys, F.lit(0).cast("long").alias("firing"),
                           F.col("_on_n").cast("long").alias("event_count"),
                           F.col("_on_sum").cast("double").alias("sum_value"))
    return first.unionByName(refires)
