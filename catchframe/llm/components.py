"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe.llm.common import stored


def _star(links: DataFrame) -> DataFrame:
    """Every node with its smallest neighbour, itself included; partial minima come before the shuffle."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for each node that has a link.

    ``links`` has two long columns ``a`` and ``b``.  A large star hangs the larger neighbours
    of each node on its smallest one, a small star the smaller ones; the links
    become stars around the roots after a number of rounds that grows with the logarithm
    of a component's size.  Each round is written to the shared folder.  Neighbours are
    never gathered in a list.
    """
    a, b = links.columns
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_star(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large_star")
        least = _star(large)
        small = (
            large.join(least, "u").select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct("u", F.col("m").alias("v")),
            )).alias("e")).select("e.*").where("u != v").distinct()
        )
        small = stored(small, "small_star")
        # Stars only: no node hangs on two others, and no centre hangs on another node.
        centres = small.select(F.col("v").alias("u")).distinct()
        done = small.count() == small.select("u").distinct().count() and small.join(centres, "u", "left_semi").isEmpty()
        edges = small
        if done:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
