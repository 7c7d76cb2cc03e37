"""Connected components by alternating large-star and small-star steps, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import checkpoint


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


#: Parts that the edges of a node are dealt to where they meet the node's least neighbour: a node may hold a third of all edges.
SALTS = 16


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges with their u's m; neither side comes dealt by u, so that Spark can also split what is still large."""
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    return dealt.join(least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))), ["u", "salt"]).drop("salt")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """u, root for every node of edges u, v (of one orderable type): root is the least node of its component.

    Each round shuffles the edges and cuts lineage; rounds grow with the logarithm
    of the longest path.  Null ends are ignored, loops and repeated edges are allowed.
    """
    now = checkpoint(edges.where("u IS NOT NULL AND v IS NOT NULL AND u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = _with_least(both.where("v > u"), least).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = _least(large)
        small = _with_least(large, down).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        now = checkpoint(small)
        seen = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    star = now.groupBy("u").agg(F.min("v").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("u"), "root").distinct())
