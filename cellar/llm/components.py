"""Connected components by alternating large and small stars.

Every round rewires edges towards the smallest neighbour; the minimum of a node is a partial
aggregate, the rewiring an equi-join that adaptive execution may split at hot nodes. Each
round is cut off with a reliable checkpoint. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import cut


def _star(pairs: DataFrame) -> DataFrame:
    """``pairs`` (n, v): every v of a node n linked to the smallest of its neighbours."""
    least = pairs.groupBy("n").agg(F.min("v").alias("m"))
    return pairs.join(least, "n").select(F.col("v").alias("a"), F.least("m", "n").alias("b"), "n")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge."""
    edge = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edge = cut(edge)
    while True:
        both = edge.select(F.col("a").alias("n"), F.col("b").alias("v")).union(
            edge.select(F.col("b").alias("n"), F.col("a").alias("v")))
        # large star: larger neighbours go to the smallest of the neighbours and the node
        large = _star(both).where("a > n").select("a", "b").where("a <> b").distinct()
        # small star: smaller neighbours and the node itself go to the smallest of them
        down = large.select(F.col("a").alias("n"), F.col("b").alias("v"))
        least = down.groupBy("n").agg(F.min("v").alias("m"))
        small = (down.join(least, "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
                 .where("a <> b").distinct())
        new = cut(small)
        # two equal sums over the edges mean that nothing moved
        if _sum(new) == _sum(edge):
            break
        edge = new
    roots = new.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _sum(edge: DataFrame) -> tuple:
    got = edge.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(got)
