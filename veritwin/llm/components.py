"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b).

    Each round hangs the larger neighbours of a node on its smallest neighbour, then the smaller ones; the edges
    end as one star per component after about log(n) rounds. A node with very many neighbours is only ever aggregated
    by min (combined before the shuffle) and the outer side of a join with one row per node, which Spark splits.
    """
    now = edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct()
    while True:
        now = shared_table(now, "edges")
        # Stars: every larger end has one edge, and none is a smaller end.
        ends = now.groupBy("a").agg(F.count("*").alias("n")).select("a", (F.col("n") > 1).alias("open"))
        inner = now.select(F.col("b").alias("a"), F.lit(True).alias("inner")).distinct()
        if ends.join(inner, "a", "left").where("open or inner").isEmpty():
            break
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = small.union(lowest.select("a", F.col("m").alias("b"))).where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", F.col("b")).distinct())
