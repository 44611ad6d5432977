"""Connected components of a link table, by alternating star operations.

Each round replaces links by links to smaller nodes until every node points
straight at the smallest node of its component. A round is two grouped minima,
combined before the shuffle, and two joins on the node, whose large keys the
adaptive planner can split. Nothing comes to the driver but two sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.common import remove_folder, scratch_folder, stored


def _towards_minimum(links: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) in both directions: each larger neighbour to the node's minimum."""
    both = links.union(links.select("b", "a"))
    # Written, so that the join below reads plain exchanges, whose large keys can be split.
    least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "least", folder)
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")


def _below_minimum(links: DataFrame) -> DataFrame:
    """Links (a, b) with a > b: the node and its smaller neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    lower = links.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return lower.union(least.select("a", "low")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the smallest node.

    Self links give a node that is its own root. Repeated links and either
    direction are allowed; nulls are not. An empty table gives an empty table.
    """
    spark = links.sparkSession
    folder = scratch_folder(spark)
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    alone = ordered.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    now = stored(ordered.where("a <> b").distinct(), "round-0", folder)
    seen, turn = None, 0
    while True:
        turn += 1
        after = stored(_below_minimum(_towards_minimum(now, f"{folder}/in-{turn}").distinct()), f"round-{turn}", folder)
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if turn > 1:
            remove_folder(spark, f"{folder}/round-{turn - 2}")
        if state == seen:
            break
        seen, now = state, after
    stars = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.union(roots).union(alone).groupBy("node").agg(F.min("root").alias("root"))
