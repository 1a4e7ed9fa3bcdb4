"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame, parts: int | None = None) -> DataFrame:
    """(id, root) for every id in links (a, b): root is the least id of its component.

    Each step pre-aggregates the least neighbour before the shuffle, and the table of these is cut off
    before it meets the links, so that a skewed join can split a hub's. Steps end when the links are
    stars: each id has one link, and no root has any. One number for each step reaches the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = common.cut(edges)
    while True:
        ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
        if not ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").count():
            break
        # large star: neighbours greater than u are linked to u's least neighbour (or u)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = common.cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and u itself are linked to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = common.cut(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
