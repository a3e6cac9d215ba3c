"""Connected components by alternating large-star and small-star steps, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialise


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """u, v: each linked id and the smallest id of its component, that one itself left out.

    `links` has ids a and b; direction, repeats and links to oneself do not matter, null ids link nothing. Each step
    is a minimum by key and a join with it, so a hub's links are never gathered; it is written out and read
    again. Steps needed grow with the logarithm of the longest chain.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(ends, "links")
    before, now = None, _mark(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        step = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialise(step.distinct(), "stars")
        before, now = now, _mark(edges)
    return edges
