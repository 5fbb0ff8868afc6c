"""Connected components of a graph given as pairs, by alternating large and small stars.

Each half round is one aggregate and one join on the node; every node's neighbours move to the smallest
one known. Rounds are written to the shared folder, so a lost executor costs at most one round, and the
number of rounds grows with the logarithm of a component's size. Only two sums per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.session import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` for each node of a pair; ``root`` is the smallest node of its component.

    Pairs of a node with itself and NULLs are ignored; repeated pairs count once. No pairs: no rows.
    """
    edges = pairs.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(edges.distinct(), "components")
    before, now = None, _mark(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = written(moved.select("e.*").filter("u != v").distinct(), "components")
        before, now = now, _mark(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
