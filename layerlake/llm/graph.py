"""Connected components by alternating large and small stars.

In a large step every neighbour of a node that is larger than it is linked to
the smallest node around; in a small step a node and its smaller neighbours
are. The links become stars after about log n rounds. Each step takes minima
per node, combined before the shuffle, and joins them back, so a node with very
many neighbours is no group in one task; adaptive execution can split its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node that has a link to another one, with the smallest node it can reach, itself included."""
    one = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
    edges = stored(one.distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        large = stored(large.where("u > v").distinct())
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        was, mark = mark, _mark(edges)
        if mark == was:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number of links and a check sum; equal ones mean that a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
