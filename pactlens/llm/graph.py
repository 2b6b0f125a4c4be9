"""Connected components of a table of links, by alternating stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with a link; the label is the least node of its component.

    Large star: each node links its greater neighbours to its least neighbour.  Small star: each node links its lesser
    neighbours and itself to the least of them.  Both keep components, and together they end in stars after a number of
    rounds that grows with the logarithm of the size.  Every round is written to the shared folder.
    """
    edges = links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = materialize(large, "large-star")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v")
        small = small.select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u <> v").distinct()
        edges = materialize(small, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())
