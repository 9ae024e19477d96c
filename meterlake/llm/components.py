"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import stored

MOST_ROUNDS = 60


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Large-star links the larger neighbours of a node to the smallest node around, small-star the node and its smaller ones.

    The smallest neighbour comes from an aggregate that Spark reduces per task, and goes
    back by a join; no list of neighbours is built.
    """
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if large:
        around = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node and component (smallest node reachable) of every node of ``links`` (a, b)."""
    links = stored(spark, links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        links = stored(spark, _stars(_stars(links, True), False), "stars")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
