"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import through_table


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b) that isn't its component's smallest; component is that smallest node.

    Each round first joins a node's larger neighbours to its smallest one, then its smaller ones, and is
    written to the shared folder, so lineage stays short. Smallest neighbours are pre-aggregated before their
    shuffle; the joins may split a hub's links. Rounds grow with the logarithm of the longest path. Loops,
    repeated links and nulls are dropped.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = through_table(edges, "links"), None
    while True:
        n, mark = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, mark) == before or not n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = (n, mark)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = through_table(small.distinct(), "links")
