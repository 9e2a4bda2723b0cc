"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node it can reach) of all nodes of `links`, whose columns a and b are longs.

    Large stars and small stars alternate until every node hangs on its least one: each round links a
    node's greater neighbours, then its lesser ones, to the least of all. A node with many
    neighbours is only ever joined to one row of its own.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("near"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("near").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("near"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("near").alias("b")).where("a <> b").unionByName(least.select("a", F.col("near").alias("b"))).distinct()
        after = stored(small, "links")
        # All is settled once no node is both below one and above another.
        if after.select("a").join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
        edges = after
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
