"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.plans.staging import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Every round links each node to the smallest node it sees, first from its larger
    neighbours, then from the smaller ones. A round is two aggregations with their
    joins over at most as many rows as there are edges; the rounds grow with the
    logarithm of the longest path. Each round is written, so lineage stays short and
    a lost executor costs one round at most.
    """
    links = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "links"
    )
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
