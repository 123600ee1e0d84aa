"""JDBC reads: partitioned snapshot and repeated polls.

A table is read by ``numPartitions`` tasks, each taking one key range of
``partition_column`` (no single reader, no duplicates). A poll re-reads the
whole table; every poll's rows carry its ``poll_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int = 8,
    properties: dict | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def tag_poll(snapshot: DataFrame, poll_id: int) -> DataFrame:
    """Rows of one poll of a whole-table snapshot."""
    return snapshot.withColumn("poll_id", F.lit(poll_id).cast("long"))
