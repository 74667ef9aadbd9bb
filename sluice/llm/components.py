"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, join_one, save


def _size(links: DataFrame) -> tuple:
    """Rows and an order-free digest of them: equal for two tables with the same links."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; the component is its least node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every node's
    neighbours are tied to the least node around it until each component is one star.
    A step is an aggregate with map-side combining and a join with its one row per node.
    In a large table the links of hubs are joined apart (``join_one``). Every round is written to the shared
    checkpoint folder; the driver sees two numbers a round. Null ends and links of a node
    to itself count for nothing; an empty table has no components.
    """
    at = save(links.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _size(at)
    while before[0]:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = save(join_one(both.filter("b > a"), least, ["a"]).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = join_one(large, least, ["a"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = save(tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        drop_saved(at, large)
        at, after = small, _size(small)
        if after == before:
            break
        before = after
    return at.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        at.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
