"""A job counter on a stream.

Rows are counted where they pass (``observe``), by the tasks that handle them, and read from the progress of every micro-batch. A
count is stored under the number of its micro-batch, so a micro-batch that is run again after a failure replaces its own count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class StreamCounter:
    def __init__(self, spark: SparkSession, path: str, name: str = "passed"):
        self.spark, self.path, self.name = spark, path, name

    def on(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.name, F.count(F.lit(1)).alias("rows"))

    def store(self, query) -> None:
        """Keep the counts of the query's finished micro-batches (as many as Spark keeps progress of, 100 unless
        ``spark.sql.streaming.numRecentProgressUpdates`` says otherwise; call it at least that often)."""
        rows = [(int(p.batchId), int(p.observedMetrics[self.name]["rows"])) for p in query.recentProgress if self.name in (p.observedMetrics or {})]
        if rows:
            (self.spark.createDataFrame(rows, "epoch long, rows long").dropDuplicates(["epoch"]).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(self.path))

    def total(self) -> DataFrame:
        return self.spark.read.schema("rows long, epoch long").parquet(self.path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("processed"))
