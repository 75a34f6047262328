"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the smallest node reachable.

    Each round links every node's larger neighbours to its smallest one, then every
    node and its smaller neighbours to their smallest. Paths shorten by half or more,
    so the rounds grow with the logarithm of the longest path. A node of any degree is
    folded before it is shuffled, and its links are never gathered. The links of a
    round are written to the shared folder, so lineage stays one round long.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = stored(links, "links"), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        links = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .where("a != b").distinct())
        least = links.groupBy("a").agg(F.min("b").alias("least"))
        near = links.join(least, "a")
        links = stored(near.select("a", F.col("least").alias("b"))
                       .unionByName(near.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")))
                       .distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
