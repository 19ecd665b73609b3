"""Connected components of links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the least of itself and its neighbours (combined before the shuffle)."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; root is the least node of its component.

    Rounds of large-star and small-star steps: each node's larger, then its
    smaller neighbours are linked to its least neighbour, until nothing changes.
    A round emits no more links than it reads, needs a logarithmic number of
    rounds, and is written to the checkpoint folder. Hubs only meet their own
    one-row minimum, so their links can be split over tasks. Null ends and
    self-links are dropped; without links the result is empty.
    """
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges, before = cut_lineage(edges), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct())
        least = _least(large)
        small = (large.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionByName(least.where("u <> least").select("u", F.col("least").alias("v"))).distinct())
        edges = cut_lineage(small)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
