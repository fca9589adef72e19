"""Connected components of a link table, by alternating stars.

Large-star links every larger neighbour of a node to the smallest of its
neighbourhood, small-star does so for the smaller ones; repeated until
the links are stars, each around the smallest id that links reach.
Each round's links are written to the shared folder, so no lineage
grows and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_held, held


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node either has one smaller neighbour and no larger one, or only larger ones."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    return (ends.groupBy("x").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
            .where("up > 1 or (up = 1 and n > 1)").isEmpty())


def _smallest(edges: DataFrame) -> DataFrame:
    """Of each u: the smallest of itself and its v. Combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) links of long ids -> (node, component) for every node in a link;
    component is the smallest node that links reach."""
    cur = held(edges.where("u <> v")
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        if _is_stars(cur):
            break
        # the smallest neighbours are held, so that both sides of the joins are plain
        # exchanges (a hot node's links can be split) or, being small, broadcast by the optimizer
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = held(_smallest(both), "low")
        large = held(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        low2 = held(_smallest(large), "low")
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        new = held(small, "links")
        for t in (cur, low, large, low2):
            drop_held(t)
        cur = new
    else:
        raise RuntimeError("components did not settle")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
