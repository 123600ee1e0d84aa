"""Running (prefix) aggregates that stay balanced when one key is huge.

A plain ``sum(x) OVER (PARTITION BY k ORDER BY o)`` sends every row of key
``k`` to one task; if one key holds a third of the data, one task reads a third
of the data. Here each key is cut into ordered *chunks* (a column that never
decreases along the order, e.g. ``floor(o / width)``), and the prefix is
computed in two balanced steps:

1. inside each ``(key, chunk)``: an ordinary running window (bounded group);
2. per ``(key, chunk)``: one total per chunk (partial aggregation, map-side
   combine), a prefix over the chunk totals of a key (one row per chunk, so
   even the hottest key has few rows), joined back on ``(key, chunk)``.

The result equals the plain window for the supported associative functions.
The join back is an equi-join on ``(key, chunk)``; AQE turns it into a
broadcast join at run time when the measured chunk table is small.

Skew-adaptive chunking (``hot_threshold``): only keys with more rows than the
threshold are cut into chunks; every other key is one chunk, so the chunk
table stays far smaller than the data when most keys are small. Hot keys are
found with one partial + final count per key and stay a frame (at most
``rows / hot_threshold`` keys, written once); a null key is a key like any
other, so a hot null key is cut too. All joins back are null-safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize

_CHUNK = "_tw_chunk"


@dataclass(frozen=True)
class RunningSpec:
    """One running aggregate: ``out = how(value)`` over the ordered prefix.

    ``how`` is one of ``sum``, ``count``, ``max``, ``min``. ``count`` ignores
    ``value`` (counts rows). ``exclusive`` leaves the current row out.
    """

    out: str
    how: str
    value: Column | str | None = None
    exclusive: bool = False


def _col(c: Column | str | None) -> Column:
    if c is None:
        return F.lit(1)
    return F.col(c) if isinstance(c, str) else c


def _agg(how: str, value: Column) -> Column:
    if how == "sum":
        return F.sum(value)
    if how == "count":
        return F.count(F.lit(1))
    if how == "max":
        return F.max(value)
    if how == "min":
        return F.min(value)
    raise ValueError(f"unsupported running aggregate {how!r}")


def _combine(how: str, offset: Column, local: Column) -> Column:
    if how == "count":
        return F.coalesce(offset, F.lit(0)) + F.coalesce(local, F.lit(0))
    if how == "sum":  # null only while every value so far is null, as in a plain window
        return F.coalesce(offset + local, offset, local)
    if how == "max":
        return F.greatest(offset, local)  # greatest/least skip nulls
    return F.least(offset, local)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` where null equals null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_tw_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_tw_r_{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(renamed, condition, how).drop(*[f"_tw_r_{k}" for k in keys])


# Keys with more rows than this are split into chunks (see module doc).
DEFAULT_HOT_THRESHOLD = 1 << 20
# The set of hot keys is broadcast up to this many keys; beyond it the join shuffles.
BROADCAST_KEYS = 100_000


CHUNK_COLUMN = _CHUNK


def with_chunks(df: DataFrame, keys: list[str], chunk: Column, threshold: int | None) -> tuple[DataFrame, bool]:
    """``df`` plus the chunk column ``_tw_chunk``; with a ``threshold`` only keys
    above it are chunked. Returns ``(frame, chunked)``; ``chunked`` is False
    when no key was split (every key is one chunk). Reuse the column for
    several running passes with ``running_aggregate(..., chunk=F.col(CHUNK_COLUMN),
    chunked=chunked)``."""
    if threshold is None or not keys:
        return df.withColumn(_CHUNK, chunk), True
    return _hot_chunk(df, keys, chunk, threshold)


def _hot_chunk(df: DataFrame, keys: list[str], chunk: Column, threshold: int) -> tuple[DataFrame, bool]:
    """``df`` plus the chunk column, chunked only for keys above ``threshold`` rows."""
    hot = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tw_n"))
                      .where(F.col("_tw_n") > threshold).select(*keys, F.lit(True).alias("_tw_hot")))
    n = hot.count()
    if n == 0:  # no hot key: every key is one chunk, no join at all
        return df.withColumn(_CHUNK, F.lit(0).cast("long")), False
    marked = _null_safe(df, F.broadcast(hot) if n <= BROADCAST_KEYS else hot, keys, "left")
    out = marked.withColumn(_CHUNK, F.when(F.col("_tw_hot"), chunk).otherwise(F.lit(0).cast("long")))
    return out.select(*df.columns, _CHUNK), True


def running_aggregate(
    df: DataFrame,
    *,
    keys: list[str],
    order: list[Column | str],
    chunk: Column,
    specs: list[RunningSpec],
    hot_threshold: int | None = None,
    chunked: bool = True,
) -> DataFrame:
    """Add one column per spec with the running aggregate along ``order``.

    ``order`` must be a total order within a key (add a unique tie breaker);
    ``chunk`` must be non-decreasing along ``order`` within a key. Rows with
    the same ``(key, chunk)`` are processed by one task, so the chunk width
    bounds the work per task. ``chunked=False`` declares every key to be one
    chunk (the chunk offsets are then empty and are skipped).
    """
    order_cols = [_col(o) for o in order]
    base, split = with_chunks(df, keys, chunk, hot_threshold)
    split = split and chunked
    d = base

    # 1. running value inside each (key, chunk)
    w_in = Window.partitionBy(*keys, _CHUNK).orderBy(*order_cols)
    locals_ = []
    for i, s in enumerate(specs):
        frame = w_in.rowsBetween(Window.unboundedPreceding, -1 if s.exclusive else Window.currentRow)
        value = _col(s.value)
        if s.how == "count":
            expr = F.count(F.lit(1)).over(frame)
        else:
            expr = _agg(s.how, value).over(frame)
        locals_.append(expr.alias(f"_tw_loc{i}"))
    d = d.select("*", *locals_)
    if not split:
        # every key is a single chunk: the running value inside it is the answer
        return d.select(*df.columns, *[
            _combine(s.how, F.lit(None), F.col(f"_tw_loc{i}")).alias(s.out) for i, s in enumerate(specs)])

    # 2. chunk totals -> exclusive prefix over the chunks of each key. Totals
    #    are aggregated from the source with partial aggregation (one row per
    #    chunk and task crosses the shuffle), not from the windowed rows.
    totals = base.groupBy(*keys, _CHUNK).agg(
        *[_agg(s.how, _col(s.value)).alias(f"_tw_tot{i}") for i, s in enumerate(specs)]
    )
    w_chunks = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        _CHUNK,
        *[
            (F.sum if s.how in ("sum", "count") else F.max if s.how == "max" else F.min)(
                f"_tw_tot{i}"
            ).over(w_chunks).alias(f"_tw_off{i}")
            for i, s in enumerate(specs)
        ],
    )

    joined = _null_safe(d, offsets, [*keys, _CHUNK], "left")
    out_cols = [
        _combine(s.how, F.col(f"_tw_off{i}"), F.col(f"_tw_loc{i}")).alias(s.out)
        for i, s in enumerate(specs)
    ]
    return joined.select(*df.columns, *out_cols)


def row_chunk(order_value: Column | str, width: int) -> Column:
    """Chunk id for a numeric order column: ``floor(value / width)``."""
    return F.floor(_col(order_value) / F.lit(width)).cast("long")
