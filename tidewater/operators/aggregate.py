"""Keyed aggregates: final sums, folds, max-by, counters, partition sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, row_chunk, running_aggregate

# Running aggregates cut each key into chunks of this many order values; with
# a unique order column (an id) this bounds the rows one task sorts per key.
DEFAULT_CHUNK_WIDTH = 1 << 16


def count_by_key(df: DataFrame, key: str, out: str = "frequency") -> DataFrame:
    """``keyBy(k).sum(1)`` final value: rows per key (partial aggregation first)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def keyed_fold(df: DataFrame, keys: list[str], value: str, fold: str, out: str) -> DataFrame:
    """``keyBy(k).reduce(f)`` for an associative, commutative ``f``.

    Built-in folds run as partial + final aggregates, so a hot key is combined
    on the map side before the shuffle.
    """
    if fold not in _FOLDS:
        raise ValueError(f"fold must be one of {sorted(_FOLDS)}")
    return df.groupBy(*keys).agg(_FOLDS[fold](value).alias(out))


def max_row_by_key(df: DataFrame, key: str, value: str, tie: str, columns: list[str]) -> DataFrame:
    """``keyBy(k).maxBy(v)``: the whole row with the largest ``v``; on ties the
    smallest ``tie`` (first arrival) wins.

    ``max(struct(v, -tie, ...))`` is an ordinary aggregate: partial per task,
    one row per key crosses the shuffle, so a hot key costs nothing extra.
    """
    others = [c for c in columns if c not in (key, value, tie)]
    best = F.max(F.struct(F.col(value).alias("v"), (-F.col(tie)).alias("neg_tie"),
                          *[F.col(c).alias(c) for c in others])).alias("best")
    agg = df.groupBy(key).agg(best)
    return agg.select(
        key,
        (-F.col("best.neg_tie")).alias(tie),
        F.col("best.v").alias(value),
        *[F.col(f"best.{c}").alias(c) for c in others],
    )


def running_by_key(
    df: DataFrame,
    key: str | list[str],
    order: str,
    value: Column | str | None,
    how: str,
    out: str,
    chunk_width: int = DEFAULT_CHUNK_WIDTH,
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """``keyBy(k).sum``/``max`` as a running value per input row, ordered by a
    numeric, unique-per-key ``order`` column. Keys above ``hot_threshold`` rows
    are split into chunks of ``chunk_width`` order values."""
    keys = [key] if isinstance(key, str) else key
    return running_aggregate(
        df, keys=keys, order=[order], chunk=row_chunk(order, chunk_width),
        specs=[RunningSpec(out, how, value)], hot_threshold=hot_threshold,
    )


def observed_count(df: DataFrame, name: str = "counter") -> tuple[DataFrame, Observation]:
    """Job-wide row counter (an accumulator): read ``obs.get`` after an action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per task partition, ``(partition, rows)``: a skew check."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
