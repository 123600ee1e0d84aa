"""Round-robin sink: row i goes to partition i mod n, as a round-robin topic partitioner deals messages.

The row's number is exact (:func:`tidewater.operators.row_index.row_index`), so partitions differ by one row at most,
whatever the number of tasks, and a retried task deals its rows to the same partitions again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.row_index import row_index


def dealt(df: DataFrame, order: str, partitions: int, out: str = "partition") -> DataFrame:
    """``df`` plus its partition (0 to ``partitions`` - 1)."""
    rows = row_index(df, order, "_tw_index")
    return rows.withColumn(out, F.expr(f"_tw_index % {partitions}")).drop("_tw_index")


def write_round_robin(df: DataFrame, path: str, order: str, partitions: int) -> None:
    """One folder per partition; every task writes its share of each."""
    dealt(df, order, partitions).write.mode("overwrite").partitionBy("partition").parquet(path)
