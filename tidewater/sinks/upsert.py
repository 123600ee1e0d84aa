"""Keyed upsert table (hash-field ``HSET`` semantics: last write per key wins).

Stored as an append log in parquet, one folder per micro-batch epoch:
``<path>/epoch=<n>/``. A batch is written with dynamic partition overwrite, so
a retried epoch replaces its own folder and nothing else (exactly once). The
current value of a key is the row of its highest epoch, computed with a
partial + final aggregate (``max_by``), so no key is read by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class UpsertLog:
    def __init__(self, spark: SparkSession, path: str, key: str, value: str, order: str | None = None):
        """``order``: column that orders repeated keys inside one batch (last wins);
        leave it out when a batch has one row per key (update-mode aggregates)."""
        self.spark, self.path, self.key, self.value, self.order = spark, path, key, value, order

    def write_batch(self, batch: DataFrame, epoch_id: int) -> None:
        """``foreachBatch`` target."""
        if self.order:
            rows = batch.groupBy(self.key).agg(F.max_by(self.value, self.order).alias(self.value))
        else:
            rows = batch.select(self.key, self.value)
        (rows.withColumn("epoch", F.lit(int(epoch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(self.path))

    def current(self) -> DataFrame:
        log = self.spark.read.parquet(self.path)
        return log.groupBy(self.key).agg(F.max_by(self.value, "epoch").alias(self.value))
