"""Connected components of links, by DataFrame joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwright.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (``a``, ``b``, any order).

    Each round links all larger neighbours of a node to its smallest neighbour, then all smaller ones, and
    ends when nothing changes: about log n rounds. Rounds are written to the shared folder. Nodes need not be
    few: minima are combined before the shuffle, and a node with very many links is split by the join.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    known = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(down, "a").select("b", "least").unionByName(down.select(F.col("a").alias("b"), "least"))
            .where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        edges = materialise(small, "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
