"""Retract changelog of a running keyed aggregate.

A continuously updated ``GROUP BY`` result, written as a changelog, emits
``(true, new)`` for each input row and, before every update of an existing
key, ``(false, old)``. Here the running value comes from the chunked running
aggregate and each input row explodes into one or two changelog rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, row_chunk, running_aggregate


def retract_changelog(
    df: DataFrame,
    key: str,
    order: str,
    value: Column | str | None = None,
    out: str = "frequency",
    chunk_width: int = 1 << 16,
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
) -> DataFrame:
    """``(order, change_seq, op, key, out)`` rows; ``change_seq`` orders the retraction
    (0) before the insertion (1) produced by the same input row. Without
    ``value`` the aggregate is a count (``sum`` of ones)."""
    specs = [RunningSpec("_tw_n", "count")]
    if value is not None:
        specs += [RunningSpec("_tw_new", "sum", value), RunningSpec("_tw_old", "sum", value, exclusive=True)]
    d = running_aggregate(df.select(key, order, *([value] if isinstance(value, str) else [])),
                          keys=[key], order=[order], chunk=row_chunk(order, chunk_width), specs=specs,
                          hot_threshold=hot_threshold)
    has_old = F.col("_tw_n") > 1  # by rows, not by value: sums may return to an earlier value
    if value is None:
        d = d.withColumn("_tw_new", F.col("_tw_n")).withColumn("_tw_old", F.col("_tw_n") - 1)
    old = F.col("_tw_old")
    changes = F.array(
        F.struct(F.lit(0).alias("change_seq"), F.lit(False).alias("op"), old.alias("v"), has_old.alias("keep")),
        F.struct(F.lit(1).alias("change_seq"), F.lit(True).alias("op"), F.col("_tw_new").alias("v"),
                 F.lit(True).alias("keep")),
    )
    # explode + where (code-generated) rather than a per-row lambda filter
    e = d.select(key, order, F.inline(changes)).where(F.col("keep"))
    return e.select(order, F.col("change_seq").cast("int").alias("change_seq"), "op", key,
                    (F.col("v").cast("long") if value is None else F.col("v")).alias(out))


def filter_changelog(changelog: DataFrame, column: str, equals) -> DataFrame:
    """A filter after the aggregate (``HAVING``) applied to the changelog:
    keeps the insert when the value reaches ``equals`` and the retraction when it leaves."""
    return changelog.where(F.col(column) == F.lit(equals))
