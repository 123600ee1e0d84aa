"""Rows from driver-side values and integer ranges.

``inline_rows`` is for small literal inputs (lookup lists, test fixtures);
large inputs must come from a distributed read. ``inclusive_range`` is
``spark.range`` with both ends included, generated in parallel by the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def inline_rows(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def inclusive_range(spark: SparkSession, start: int, end: int, num_partitions: int | None = None,
                    name: str = "id") -> DataFrame:
    """Longs ``start..end`` with both ends included."""
    return spark.range(start, end + 1, 1, num_partitions).withColumnRenamed("id", name)
