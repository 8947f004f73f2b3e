"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); ``root`` is the
    smallest node that can be reached.

    Large-star and small-star steps alternate until nothing changes: every
    node is tied to its smallest neighbour, so the depth of the forest falls
    geometrically. Each round is written to the shared folder, which cuts the
    lineage. No component is ever gathered in one place.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "cc-start")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that what is joined are plain shuffles, whose hot keys Spark splits
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-least")
        # large star: neighbours above a node hang below the node's smallest neighbour
        large = materialise(edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")), "cc-large")
        # small star: neighbours below a node, and the node, hang below the smallest of them
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(small.select("e.*").where("a <> b").distinct(), "cc-round")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
