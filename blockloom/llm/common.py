"""Column expressions and small plans that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage

#: White space of all text rules here: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"



def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once in each worker process. Functions reach
    workers by value, so a module's own variables end with the task. A worker
    that goes on with another operator lets go of what it had."""
    store = sys.__dict__.setdefault("_blockloom_kept", {})
    if key not in store:
        store.clear()
        store[key] = make()
    return store[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_spaced(text: Column) -> Column:
    """Text with every run of white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def word_count(text: Column) -> Column:
    """Number of words, counted from the blanks between them."""
    words = F.trim(one_spaced(text))
    blanks = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", 0).otherwise(blanks + 1).cast("long")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all ids that no model learns from; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, the same ones on every run: those whose
    key hashes below the share of rows that is wanted."""
    total = rows.count()
    if total <= most:
        return rows
    space = 1 << 30
    return rows.where(F.pmod(F.xxhash64(F.lit(71), F.col(key)), F.lit(space)) < int(space * 0.97 * most / total))


def ranked(df: DataFrame, group: list[str], order: list[Column], label: str) -> DataFrame:
    """``df`` with ``rank`` (from 1) within ``group`` by ``order``.

    A range sort lays equal groups over as many partitions as they need; the
    counts per partition and group, a few rows, are summed up and added to
    the place inside the partition. No group meets in one task.
    """
    keys = [F.col(c).asc_nulls_last() for c in group] + order
    laid = stage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = laid.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    l, r = laid.alias("l"), runs.alias("r")
    same = F.col("l._part") == F.col("r._part")
    for c in group:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return l.join(r, same).select("l.*", (F.col("r._before") + F.col("l._at") - F.col("r._first") + 1).alias("rank")).drop("_at", "_part")
