"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.llm.storage import staged


def _sum_of(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node of its component) for every node of ``links`` (long columns a, b).

    Nulls and self-links are left out.  Every round points each node's larger, then its smaller neighbours at its least
    neighbour, and writes the links that remain; only their number and a checksum reach the driver.
    """
    edges = links.where("a is not null and b is not null and a <> b").select("a", "b")
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _sum_of(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a <> b").distinct())
        after = _sum_of(edges)
        if after == before:
            break
        before = after
    # what is left is one star for each component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
