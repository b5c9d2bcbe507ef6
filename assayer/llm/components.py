"""Connected components over link tables, on Spark from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffled, written


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of one orderable type -> (node, root): the least node of each component, for linked nodes.

    Alternates the large-star and small-star steps, which keep the components and shorten the paths; every
    step is one shuffle with partial aggregation of minima, and ends in stars. Hubs are harmless: a node's
    neighbours are never gathered, only their minimum is taken and joined back.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: every larger neighbour of a node is linked to the least of the node and its neighbours
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours are linked to the least of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(shuffled(least), "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.a", "e.b").where("a <> b").distinct())
        # done when the links are stars: no node is both root and leaf, no leaf has two roots
        facts = now.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        discard(links)
        two = facts.where("n > 1").limit(1).count()
        if not two and not now.select("a").join(shuffled(now.select(F.col("b").alias("a")).distinct()), "a", "left_semi").limit(1).count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = now
