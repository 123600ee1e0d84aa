"""Top-k per group with an explicit tie order.

``row_number() <= k`` over a window is planned with a ``WindowGroupLimit``
below the shuffle, so each task keeps only its local top k per group before
rows are exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
