"""Connected components of links, by alternating large and small stars.

Each round is a few joins and aggregations by node; nothing is gathered per
node, so a node with very many links is only a key that the skew join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewright.session import shared_folder


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every linked node
    that is not its own root. Links with a null or of a node to itself say nothing."""
    shared_folder(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    edges = edges.checkpoint()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").where("v > m").toDF("u", "v")
        edges = small.unionByName(least.toDF("u", "v")).distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.toDF("node", "root")
        state = now
