"""Lookup enrichment against a dimension (the broadcast-set pattern).

A plain left join: Spark broadcasts the dimension when its size in bytes, as
estimated or as measured at run time (AQE), is below
``spark.sql.autoBroadcastJoinThreshold``, and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_last(dim: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key; on duplicate keys the last one by ``order`` wins (map put)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return dim.withColumn("_tw_rn", F.row_number().over(w)).where("_tw_rn = 1").drop("_tw_rn")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fields: dict[str, object],
) -> DataFrame:
    """Left lookup of ``fields`` (name -> default for a missing key) from ``dim``.

    ``dim`` must already have one row per key (see :func:`dedupe_last`).
    """
    joined = fact.join(dim.select(key, *fields.keys(), F.lit(True).alias("_tw_match")), on=key, how="left")
    for name, default in fields.items():     # a null of a matched row stays null
        joined = joined.withColumn(name, F.when(F.col("_tw_match"), F.col(name)).otherwise(F.lit(default)))
    return joined.drop("_tw_match")
