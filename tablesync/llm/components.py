"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablesync.llm.common import settled


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """The nodes of `links` (a, b: long), as (node, root): root is the least node that can be reached.

    Large-star and small-star rounds, until nothing changes: every node hands its least
    neighbour to its larger ones, then to its smaller ones. Rounds grow with the logarithm
    of a component's size. Each is two joins on a node; a node with very many links is an
    ordinary skewed key there, which adaptive execution splits. No row is ever grouped.
    """
    links = settled(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(links)
    while state[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        after = settled(small.union(least.select("a", "root")).where("a != b").distinct())
        now = _state(after)
        links, (state, before) = after, (now, state)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
