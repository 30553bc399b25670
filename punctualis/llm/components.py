"""Connected components of a graph of links, as Spark jobs (large-star and small-star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctualis.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node with a link (columns a, b).

    Each step needs the least neighbour of every node, a pre-aggregated minimum, and a merge join back, whose hot
    partitions Spark can split; a star with a third of all nodes is no single task. Every step is written to the
    shared folder. Links to the least node seen replace the links of each node, until nothing changes.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = large.join(least, F.col("a") == F.col("u"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
