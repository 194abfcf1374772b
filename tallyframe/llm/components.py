"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import stored


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; ``component`` is the smallest node reachable.

    Rounds of large-star and small-star steps (each a minimum per node, joined back) until the
    links are stars. A step never collects the neighbours of a node: minima are combined before the
    shuffle, and a node with many links is split by the skew join. Links with a null end and links
    of a node to itself are left out; an empty table gives no rows. Each round is written to the
    shared folder, so a lost executor costs at most one round.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b))
    edges, before = stored(ends.distinct(), "links"), None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(roots.select("node", F.col("node").alias("component")))
