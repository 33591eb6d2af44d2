"""The block at a point in time: an as-of lookup without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import label_join

_DAY = 86_400


def blocks_at(probes: DataFrame, blocks: DataFrame, closest: str = "before", bucket_seconds: int = _DAY) -> DataFrame:
    """Add ``block_number`` to ``probes`` (chainid, t) from ``blocks`` (chainid, block_number, time_stamp).

    ``before``: the last block at or before ``t``; ``after``: the first at or
    after it; NULL if there is none.

    Both sides first shrink to one row per chain and second. A window bucket
    of ``bucket_seconds`` then holds at most that many rows of each side, no
    matter how the data is skewed. Buckets without an earlier block take the
    nearest one from a frame of one row per chain and bucket. The answers go
    back to all probes by a join that spreads a second many of them share.
    """
    if closest not in ("before", "after"):
        raise ValueError("closest is 'before' or 'after'")
    before = closest == "before"
    pick = F.max if before else F.min
    edge_of = F.max_by if before else F.min_by

    def bucket(t: str):
        return F.floor(F.col(t) / bucket_seconds).cast("bigint")

    known = (
        blocks.groupBy("chainid", F.col("time_stamp").alias("t"))
        .agg(pick("block_number").alias("_block"))
        .withColumn("_bucket", bucket("t"))
    )
    asked = (
        probes.select("chainid", "t")
        .dropDuplicates()
        .withColumn("_block", F.lit(None).cast("bigint"))
        .withColumn("_bucket", bucket("t"))
    )
    # On equal seconds the block row comes first, so it counts for the probe.
    sided = known.withColumn("_asked", F.lit(0)).unionByName(asked.withColumn("_asked", F.lit(1)))
    order = [F.col("t") if before else F.col("t").desc(), F.col("_asked")]
    inside = (
        Window.partitionBy("chainid", "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = sided.withColumn("_near", F.last("_block", ignorenulls=True).over(inside)).where("_asked = 1")

    # Nearest non-empty bucket on the far side, for every bucket in use.
    edges = known.groupBy("chainid", "_bucket").agg(edge_of("_block", "t").alias("_edge"))
    used = edges.unionByName(
        asked.select("chainid", "_bucket", F.lit(None).cast("bigint").alias("_edge"))
        .dropDuplicates()
    )
    per_bucket = used.groupBy("chainid", "_bucket").agg(F.max("_edge").alias("_edge"))
    across = (
        Window.partitionBy("chainid")
        .orderBy(F.col("_bucket") if before else F.col("_bucket").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_bucket.select(
        "chainid", "_bucket", F.last("_edge", ignorenulls=True).over(across).alias("_carried")
    )
    answers = found.join(carried, ["chainid", "_bucket"], "left").select(
        "chainid", "t", F.coalesce("_near", "_carried").alias("block_number")
    )
    return label_join(probes, answers, ["chainid", "t"])
