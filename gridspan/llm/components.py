"""Connected components of link tables, by alternating star steps on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _down(edges: DataFrame) -> DataFrame:
    """Every pair once, the larger node first."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links ``(a, b)`` other than the roots, which are the least nodes.

    Minima are partial sums, and the joins on a node are left to adaptive execution, so a node
    with very many links is no bottleneck.  Each round is written to the shared folder.
    """
    now, before = stage(_down(edges), "links"), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _down(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        now = stage(_down(small), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
