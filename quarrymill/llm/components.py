"""Connected components of an edge list, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("w"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return moved.union(least.select("u", F.col("w").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: longs u and v, no nulls; repeated edges and loops are allowed.

    Returns u and root for every node of an edge between different nodes, root being the least node of u's component
    (roots themselves are left out). An empty edge list gives an empty result. Rounds grow with the logarithm of
    the longest path; each is written to the shared folder.
    """
    at = stored(edges.filter("u <> v").select("u", "v"), "edges")
    mark = None
    while True:
        now = at.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first()
        if tuple(now) == mark or now[0] == 0:
            return at.select("u", F.col("v").alias("root"))
        mark = tuple(now)
        at = stored(_small_star(_large_star(at)), "edges")
