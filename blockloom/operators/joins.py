"""Joining a large, skewed table to a table of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as JSON text: one distributed aggregate, one number back."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("n")).first()["n"]


def label_join(
    facts: DataFrame,
    labels: DataFrame,
    keys: list[str],
    label_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of ``facts`` to ``labels`` on ``keys``, whatever the skew.

    Labels measured to fit are broadcast, so the facts do not move. Larger
    ones are joined by a shuffle, whose partitions Spark splits where a key
    is hot: the preserved side of a left join may be cut anywhere, so no task
    gets a whole hot key. ``label_bytes`` is an upper bound a caller has
    measured already; without it the labels are written to the shared folder
    first, so that measuring does not compute them twice.
    """
    if label_bytes is None:
        labels = stage(labels, "labels")
        label_bytes = measured_bytes(labels)
    if label_bytes <= broadcast_bytes:
        return facts.join(F.broadcast(labels), keys, "left")
    return facts.join(labels.hint("merge"), keys, "left")
