"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Every step is a minimum per node (partial + final aggregate) and an equi-join back, so a node with very
many links is neither collected nor held by one task. Nothing comes to the driver but one row
per round, which says whether the links are stars by now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved


def _normal(e: DataFrame) -> DataFrame:
    """Links as (larger, smaller), each once, without loops."""
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _stars(e: DataFrame) -> bool:
    """True if every node has one link downwards at most, and none that has one is the lower end of another."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        e.select(F.col("v").alias("n"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    per = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    worst = per.agg(F.max("down").alias("down"), F.max(F.col("down") * F.col("up")).alias("both")).first()
    return (worst["down"] or 0) <= 1 and not worst["both"]


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node with a link that is not itself the root (the least of its component); links: columns u, v.

    ``known`` has the components of earlier links: the new ones are then links between their roots, mostly few."""
    links = links.select("u", "v")
    if known is not None:
        for c in ("u", "v"):
            at = known.select(F.col("node").alias(c), F.col("root").alias("_to"))
            links = links.join(at, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    e = saved(_normal(links), "links")
    if known is not None and e.isEmpty():
        return known
    while not _stars(e):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _normal(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = saved(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(_normal(small.unionAll(least.select("u", F.col("m").alias("v")))), "small-star")
    found = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if known is None:
        return found
    moved = known.join(found.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
    return saved(moved.select("node", F.coalesce("_to", "root").alias("root")).unionAll(found), "components")
