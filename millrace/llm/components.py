"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Stored, discard, stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has a single edge and is no smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    apart = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return apart.agg(F.count(F.when(F.col("up") + F.col("down") > 1, 1)).alias("n")).first().n == 0


def _with_least(edges: DataFrame, of: str, other: str) -> DataFrame:
    """Each edge with the least node around its end `of`."""
    least = edges.groupBy(of).agg(F.min(other).alias("least")).select(F.col(of).alias("node"), "least")
    return edges.join(least, edges[of] == least["node"]).select("u", "v", F.least("least", F.col(of)).alias("least"))


def components(edges: DataFrame) -> Stored:
    """Rows (node, component) of every node of `edges` (u, v); a component is known by its least node.

    Large-star and small-star in turn: a node's larger neighbours move to its least neighbour, then its smaller ones do.
    The number of rounds grows with the logarithm of the graph; they end when all edges lead to roots, which a further
    round would not change. A node's neighbours are reduced to their least before they meet; a hub's edges are joined to
    that single row, which adaptive execution can split.
    """
    spark = edges.sparkSession
    own = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(own, "edges")
    while not _are_stars(now.df):
        # Edges point from the larger node u to the smaller v.
        both = now.df.union(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        starred = stored(large.where("u != v"), "large-star")  # an edge each; equal ones are dropped below
        small = _with_least(starred.df, "u", "v")
        moved = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            small.select("u", F.col("least").alias("v"))
        )
        after = stored(moved.where("u != v").distinct(), "small-star")
        discard(spark, now, starred)
        now = after
    roots = now.df.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    labels = stored(now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
    discard(spark, now)
    return labels
