"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import drop_table, materialize


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours; the minimum is combined before it is shuffled."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with v < u: every smaller neighbour of u, and u itself, goes to the least of them."""
    hung = _least_neighbour(edges).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return hung.filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): root is the least node reachable; nodes that are their own root and nodes without links are left out.

    Null ends and loops are ignored; repeated links count once. Rounds end when the edges no longer change, which
    takes a number of rounds that grows with the logarithm of the components' size.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges, state = materialize(ends.distinct(), "links"), None
    while True:
        sign = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(sign) or not sign[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(sign)
        after = materialize(_small_star(_large_star(edges)), "links")
        drop_table(edges)
        edges = after
