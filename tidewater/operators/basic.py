"""Stateless operators: tag split (side outputs), connect, union, filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = "tag"


def tag_rows(df: DataFrame, tag: Column, name: str = TAG) -> DataFrame:
    """Attach the side-output tag of every row (one pass, no shuffle)."""
    return df.withColumn(name, tag)


def split_by_tag(df: DataFrame, tag: Column, tags: list[str], persist: bool = True) -> dict[str, DataFrame]:
    """Side outputs: one frame per tag value.

    The tagged frame is persisted (memory and disk) when several outputs are
    consumed, so the input is read once; callers unpersist when done.
    """
    tagged = tag_rows(df, tag)
    if persist:
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    return {t: tagged.where(F.col(TAG) == F.lit(t)).drop(TAG) for t in tags}


def even_odd_tag(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.when(F.pmod(c, F.lit(2)) == 0, F.lit("even")).otherwise(F.lit("odd"))


def connect_map(
    left: DataFrame,
    left_fn: Callable[[DataFrame], DataFrame],
    right: DataFrame,
    right_fn: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different types mapped to one output type, then merged.

    Each side keeps its own partitions; ``unionByName`` adds no shuffle.
    """
    return left_fn(left).unionByName(right_fn(right))


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union (duplicates kept), matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def exclude_value(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows whose ``column`` differs from ``value`` (nulls kept out, as Java equals)."""
    return df.where(F.col(column) != F.lit(value))
