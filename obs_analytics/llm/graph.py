"""Connected components of large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm.checkpoints import drop, table


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.
    ``links`` has long columns a, b. Alternates the large-star and small-star
    steps until all links are stars; each step is a grouped minimum (combined
    before the shuffle) and a join back, and is written to the shared folder (the
    step before it is deleted), so neither links nor nodes pass through the
    driver. Nulls link nothing."""
    edges = table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = table(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        done, edges = edges, table(small.where("u <> v").distinct(), "small-star")
        drop(done)
        drop(large)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node links to one smaller node that links to none itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 or (down = 1 and up = 1)").limit(1).count() == 0
