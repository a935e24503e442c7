"""Connected components of a distributed edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node of its component.

    Each round is written to the shared folder, so nothing is recomputed after a lost executor and no
    edge passes through the driver, which sees one checksum a round. A node with very many neighbours is
    never gathered: its minimum is an aggregate, and the join back is one that Spark can split.
    """
    a, b = F.col("a"), F.col("b")
    links = stage(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    seen = _checksum(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(low).distinct())
        links = stage(small, "links")
        now = _checksum(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)
