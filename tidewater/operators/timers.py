"""Keyed timers re-expressed as ordered lookups.

A keyed process function that registers a timer ``interval`` after each
order and checks a review at firing time is, on a bounded input, a question
about the *next* event of a key after a point in time. We answer it with the
classic as-of technique: union the query points with the events of the key,
walk the key in descending time and keep a running minimum of event times.
The walk uses the chunked running aggregate, so a hot key is split into time
chunks and no pairs of rows are ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.hashing import char_code_parity
from tidewater.functions.timefn import epoch_micros, from_epoch_micros
from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, running_aggregate
from tidewater.operators.windows import duration_micros

REVIEWED = "reviewed"
AUTO_GOOD_REVIEW = "auto_good_review"


def next_event_after(
    points: DataFrame,
    events: DataFrame,
    key: str,
    point_us: str,
    event_us: str,
    chunk_us: int,
    out: str = "next_us",
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """For every row of ``points``: the smallest ``event_us`` of the same key that is
    strictly greater than its ``point_us`` (null when none)."""
    p = points.withColumn("_tw_t", F.col(point_us)).withColumn("_tw_is_point", F.lit(1)) \
        .withColumn("_tw_ev", F.lit(None).cast("long"))
    e = events.select(key, F.col(event_us).alias("_tw_t"), F.lit(0).alias("_tw_is_point"),
                      F.col(event_us).cast("long").alias("_tw_ev"))
    for c in points.columns:
        if c not in e.columns:
            e = e.withColumn(c, F.lit(None).cast(points.schema[c].dataType))
    both = p.unionByName(e.select(*p.columns))
    # Descending time; at equal time the point comes first, so an event at the
    # same instant is not "after" it.
    walked = running_aggregate(
        both, keys=[key],
        order=[F.col("_tw_t").desc(), F.col("_tw_is_point").desc()],
        chunk=-F.floor(F.col("_tw_t") / F.lit(chunk_us)).cast("long"),
        specs=[RunningSpec(out, "min", "_tw_ev")], hot_threshold=hot_threshold,
    )
    return walked.where("_tw_is_point = 1").drop("_tw_t", "_tw_is_point", "_tw_ev")


def order_timeout(
    orders: DataFrame,
    reviews: DataFrame,
    key: str,
    order_id: str,
    ts: str,
    interval: str,
    chunk: str = "1 minute",
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """Per order: ``due_at = ts + interval``; ``reviewed`` when the same key has a
    review in ``(ts, due_at]``, else the job gives the default good review.
    Output: ``(order_id, key, order_ts, due_at, status)``."""
    i_us = duration_micros(interval)
    o = orders.select(F.col(order_id), F.col(key), F.col(ts).alias("order_ts"),
                      epoch_micros(ts).alias("_tw_o_us"))
    r = reviews.select(F.col(key), epoch_micros(ts).alias("_tw_r_us"))
    nxt = next_event_after(o, r, key, "_tw_o_us", "_tw_r_us", duration_micros(chunk), hot_threshold=hot_threshold)
    status = F.when(F.col("next_us").isNotNull() & (F.col("next_us") <= F.col("_tw_o_us") + F.lit(i_us)),
                    F.lit(REVIEWED)).otherwise(F.lit(AUTO_GOOD_REVIEW))
    return nxt.select(order_id, key, "order_ts",
                      from_epoch_micros(F.col("_tw_o_us") + F.lit(i_us)).alias("due_at"),
                      status.alias("status"))


def order_timeout_drain(
    orders: DataFrame,
    key: str,
    order_id: str,
    ts: str,
    interval: str,
    chunk: str = "1 minute",
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """Literal timer behaviour: each timer handles *all* orders of its key in state.

    An order at ``t`` is handled by the first timer of its key that fires after
    it arrived: ``min{t_i + interval : t - interval < t_i <= t}``, i.e. the
    earliest order of the key later than ``t - interval``, plus ``interval``
    (times in whole milliseconds; a timer due at the same instant as an order
    fires before the order is processed). The review lookup is the JVM string
    hash parity of the order id (even = already reviewed).
    Output: ``(order_id, key, order_ms, handled_ms, status)``.
    """
    i_ms = duration_micros(interval) // 1000
    o = orders.select(F.col(order_id), F.col(key),
                      F.floor(epoch_micros(ts) / F.lit(1000)).cast("long").alias("order_ms"))
    q = o.withColumn("_tw_q", F.col("order_ms") - F.lit(i_ms))
    ev = o.select(key, F.col("order_ms").alias("_tw_ev_ms"))
    nxt = next_event_after(q, ev, key, "_tw_q", "_tw_ev_ms", duration_micros(chunk) // 1000, out="_tw_first",
                           hot_threshold=hot_threshold)
    integral = isinstance(orders.schema[order_id].dataType, T.IntegralType)
    status = F.when(char_code_parity(F.col(order_id), integral=integral) == 0, F.lit(REVIEWED)) \
        .otherwise(F.lit(AUTO_GOOD_REVIEW))
    return nxt.select(order_id, key, "order_ms",
                      (F.col("_tw_first") + F.lit(i_ms)).alias("handled_ms"), status.alias("status"))
