"""Ordered work over a stream in two levels: running operators over the rows of a micro-batch, and one carry per key between them.

The rows of a micro-batch go through the chunked running aggregates of ``operators.running``, so the rows of a
hot key are split among tasks and everything is built-in expressions. What a key hands on to the next micro-batch (a maximum, a count, the
last few rows) is one row of a :class:`CarryTable`. A micro-batch writes its output and its carry into folders of its own number,
so one that is run again replaces only itself: every row counts exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, _null_safe, row_chunk, running_aggregate

#: micro-batches after which the carries of all keys are written anew
BASE_EVERY = 16


class CarryTable:
    """One row per key and micro-batch that touched it; every ``BASE_EVERY`` micro-batches one of all keys, so reading takes
    one base and a bounded number of changes. Micro-batches are numbered without gaps."""

    def __init__(self, path: str, keys: list[str], carry: str):
        """``carry``: the DDL type of the carry, a struct."""
        self.path, self.keys, self.carry = path, keys, carry

    def before(self, spark: SparkSession, epoch: int, schema: str) -> DataFrame:
        """(keys, carry) as the micro-batches before ``epoch`` left it; ``schema``: DDL of the keys."""
        full = f"{schema}, carry {self.carry}, epoch long"
        if epoch == 0:
            return spark.createDataFrame([], full).drop("epoch")
        base = (epoch - 1) // BASE_EVERY * BASE_EVERY
        log = spark.read.schema(full).parquet(*[f"{self.path}/{e:09d}" for e in range(base, epoch)])
        return log.groupBy(*self.keys).agg(F.max_by("carry", "epoch").alias("carry"))

    def write(self, changed: DataFrame, old: DataFrame, epoch: int) -> None:
        """The carries that this micro-batch changed; in a base also those of all other keys."""
        rows = changed.select(*self.keys, F.col("carry").cast(self.carry).alias("carry"), F.lit(int(epoch)).cast("long").alias("epoch"))
        if epoch and epoch % BASE_EVERY == 0:
            kept = _null_safe(old, changed.select(*self.keys), self.keys, "left_anti")
            rows = rows.unionByName(kept.withColumn("epoch", F.lit(int(epoch)).cast("long")))
        rows.write.mode("overwrite").parquet(f"{self.path}/{epoch:09d}")


def with_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` plus the column ``carry`` of their key (null for a new key)."""
    return _null_safe(rows, carry, keys, "left")


class CarryJob:
    """``foreachBatch`` target. ``step(rows, carry)`` gives (output rows, changed carries) of a micro-batch."""

    def __init__(self, table: CarryTable, key_schema: str, out: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]):
        self.table, self.key_schema, self.out, self.step = table, key_schema, out, step

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            old = self.table.before(batch.sparkSession, epoch, self.key_schema)
            done, changed = self.step(batch, old)
            done.write.mode("overwrite").parquet(f"{self.out}/{epoch:09d}")
            self.table.write(changed, old, epoch)
        finally:
            batch.unpersist()


def running_max_step(key: str, order: str, value: str, width: int = 1 << 16, hot: int | None = DEFAULT_HOT_THRESHOLD):
    """Per key the largest value so far; null while all values are null."""
    def step(batch: DataFrame, carry: DataFrame):
        inside = running_aggregate(batch.select(key, order, value), keys=[key], order=[order], chunk=_chunk(order, width),
                                   specs=[RunningSpec("_max", "max", value)], hot_threshold=hot)
        out = with_carry(inside, carry, [key]).select(order, key, value, F.greatest("carry.best", "_max").alias("max_value"))
        now = with_carry(batch.groupBy(key).agg(F.max(value).alias("_max")), carry, [key])
        return out, now.select(key, F.struct(F.greatest("carry.best", "_max").alias("best")).alias("carry"))

    return step, "struct<best:double>"


def _chunk(order: str, width: int) -> Column:
    return F.coalesce(row_chunk(order, width), F.lit(-(1 << 62)))       # rows without an order come first


def changelog_step(key: str, order: str, out: str = "frequency", width: int = 1 << 16, hot: int | None = DEFAULT_HOT_THRESHOLD):
    """Retract changelog of a running count: for each row ``(false, old)`` if the key had a count, then ``(true, new)``."""
    def step(batch: DataFrame, carry: DataFrame):
        inside = running_aggregate(batch.select(key, order), keys=[key], order=[order], chunk=_chunk(order, width),
                                   specs=[RunningSpec("_n", "count")], hot_threshold=hot)
        seen = F.coalesce("carry.n", F.lit(0)).cast("long")
        rows = with_carry(inside, carry, [key]).withColumn("_n", seen + F.col("_n"))
        change = F.inline(F.array(F.struct(F.lit(0).alias("change_seq"), F.lit(False).alias("op"), (F.col("_n") - 1).alias(out)),
                                  F.struct(F.lit(1).alias("change_seq"), F.lit(True).alias("op"), F.col("_n").alias(out))))
        now = with_carry(batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), carry, [key])
        return (rows.select(order, key, change).where(F.col(out) > 0).select(order, "change_seq", "op", key, out),
                now.select(key, F.struct((seen + F.col("_n")).alias("n")).alias("carry")))

    return step, "struct<n:bigint>"


def count_window_step(key: str, order: str, value: str, size: int, slide: int, amount: Callable[[str], Column],
                      width: int = 1 << 16, hot: int | None = DEFAULT_HOT_THRESHOLD):
    """Count windows: at every ``slide``-th row of a key the sum of its last ``size`` rows. The carry is the number of
    rows seen and the last ``size`` - 1 of them. ``amount`` makes an exact number of a value; a null one counts as a row."""
    kind = "decimal(27,9)"

    def step(batch: DataFrame, carry: DataFrame):
        rows = running_aggregate(batch.select(key, order, amount(value).cast(kind).alias("_v")), keys=[key], order=[order],
                                 chunk=_chunk(order, width), specs=[RunningSpec("_n", "count")], hot_threshold=hot)
        seen = F.coalesce("carry.n", F.lit(0)).cast("long")
        rows = with_carry(rows, carry, [key]).select(key, order, "_v", (seen + F.col("_n")).alias("_n"), seen.alias("_seen"))
        touched = with_carry(batch.groupBy(key).agg(F.count(F.lit(1)).alias("_new")), carry, [key])
        touched = touched.select(key, seen.alias("_seen"), (seen + F.col("_new")).alias("_all"), F.col("carry.tail").alias("_tail"))
        tail = touched.select(key, "_seen", F.inline("_tail")).select(key, F.col("o").alias(order), F.col("v").alias("_v"), F.col("n").alias("_n"), "_seen")
        every = rows.unionByName(tail)
        # row n is in the windows that end at a multiple of slide from n to n + size - 1, and after the rows seen before
        first = F.greatest(F.ceil(F.col("_n") / slide), F.floor(F.col("_seen") / slide) + 1).cast("long")
        last = F.floor((F.col("_n") + (size - 1)) / slide).cast("long")
        ids = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        windows = every.withColumn("window_index", F.explode(ids)).groupBy(key, "window_index").agg(
            F.max("_n").alias("_last"), F.count(F.lit(1)).alias("event_count"), F.sum("_v").cast("double").alias("sum_value"),
            F.max_by(order, "_n").alias(f"last_{order}"))
        out = windows.where(F.col("_last") == F.col("window_index") * slide).select(key, "window_index", "event_count", "sum_value", f"last_{order}")
        total = _null_safe(every, touched.select(key, "_all"), [key], "left")
        kept = total.where(F.col("_n") > F.col("_all") - (size - 1)).groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct(F.col("_n").alias("n"), F.col("_v").alias("v"), F.col(order).alias("o")))).alias("tail"))
        now = _null_safe(touched.select(key, "_all"), kept, [key], "left")
        return out, now.select(key, F.struct(F.col("_all").alias("n"), "tail").alias("carry"))

    return step, f"struct<n:bigint,tail:array<struct<n:bigint,v:{kind},o:bigint>>>"
