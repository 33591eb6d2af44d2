"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / source_size`` times. The
expected copies are summed up along the source, one random offset is added,
and a document is emitted once for each integer the sum crosses at it. The
source is walked from its largest document to its smallest, which keeps the
words taken within the size of one document of the target.

Nulls and ties: a null text has no words; a null source is a source of its
own, the last one; null ids come last. Ties in size go by doc_id, then by a
hash of the whole row; rows that are equal altogether are interchangeable.
A source without words has target 0 and none of its documents is taken.
An empty table gives an empty result. Columns beside the documents' own,
whatever their names, pass through ``mix`` untouched.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import ranked, table, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MOST_COPIES = 3
SEED = 20240229


def offset(seed: int = SEED) -> float:
    return random.Random(seed).random()


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Targets are ``least(most * size, weight * level)`` for the one level at
    which they sum up to all sizes. With sources ordered by ``most * size /
    weight``, those that stop are the first ones, and the level is the
    largest of "what the sources before leave, per weight that remains".
    One row per source; the windows see nothing larger.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = sources.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    level = (
        F.sum("source_size").over(Window.partitionBy())
        - F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ) / F.sum("_weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("_level", level).withColumn("_level", F.max("_level").over(Window.partitionBy()))
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_level"))
    return sources.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, row_hash) per row of ``docs``."""
    # The only look at the texts; all that follows reads these few columns.
    sized = stage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)]).alias("row_hash")),
        "sizes",
    )
    walk = [F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col("row_hash")]
    rows = ranked(sized, ["source"], walk, "mix").alias("d")
    targets = source_targets(sized, weights, most).alias("t")
    rows = rows.join(targets, F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = rows.select("d.doc_id", "d.source", "d.size", "d.row_hash", "d.rank", "t.source_size", "t.target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda r: F.floor(r * each + F.lit(offset(seed)))
    copies = F.least(crossed(F.col("rank")) - crossed(F.col("rank") - 1), F.lit(most))
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("rank")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The documents themselves, each as often as the plan says."""
    key = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)])
    names = docs.columns
    decided = plan(docs, weights, most, seed).groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("_rows"), F.sum("copies").alias("_copies"))
    decided = stage(decided, "copies").alias("p")
    d = docs.withColumn("_key", key).alias("d")
    joined = d.join(
        decided.where(F.col("_copies") > 0),
        F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._key") == F.col("p.row_hash")),
    ).select("d.*", "p._rows", "p._copies")
    out = joined.where(F.col("_rows") == 1)
    if not decided.where(F.col("_rows") > 1).isEmpty():
        # Equal rows share their copies: one of them stands for all.
        out = out.unionByName(joined.where(F.col("_rows") > 1).dropDuplicates(["doc_id", "_key"]))
    times = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return out.withColumn("_time", times).select(*[F.col(f"`{c}`") for c in names])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = f"""
with sized as (
  select doc_id, source,
    cast(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as bigint) as size
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sized group by source),
levels as (
  select *, max(level) over () as top from (
    select *, ((sum(source_size) over ()) - coalesce(sum(3 * source_size) over (
        order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following) as level
    from sources)),
targets as (
  select source, source_size, least(cast(3 * source_size as double), weight * top) as target from levels),
placed as (
  select s.doc_id, s.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0 end as each,
    row_number() over (partition by s.source order by s.size desc, s.doc_id nulls last) as place
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast(least(floor(place * each + {offset()!r}::double) - floor((place - 1) * each + {offset()!r}::double), 3) as bigint) * size as taken
from placed
"""
