"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b); a component is named
    by its smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones,
    on the smallest node next to it; the edges are stars when nothing changes.
    A node's neighbours are never gathered: only their minimum is worked out,
    and joined back to the edges.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stage(edges.where("a <> b").select(larger, smaller).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        now = stage(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = stage(now.groupBy("a").agg(F.min("b").alias("m")), "least")
        hung = now.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
