"""Connected components of a table of links, by alternating stars.

Every round points each node at the smallest neighbour it knows of, once for larger
and once for smaller neighbours. Links are only ever joined and aggregated; none
reach the driver. A node with very many neighbours is salted in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written

SALTS = 8


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges (u, v)`` with ``m`` of ``least (u, m)``."""
    left = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    right = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, ["u", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node reachable."""
    stars = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        stars = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
