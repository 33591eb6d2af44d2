"""Sets of block ranges: unions, what they cover, and what they leave out.

Ranges are rows with ``from_block`` and ``to_block``, both inside, under key
columns such as chain and contract; NULL keys are keys. Rows with a missing or
reversed bound hold no block and are left out. Every function first unites the
ranges near each other, in pieces of the block axis, so that a contract with a
third of all ranges reaches the window over its key as a few islands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN_BLOCKS = 1_000_000


def _islands(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps and islands: a range that begins past all before it opens an island."""
    order = Window.partitionBy(*keys).orderBy("from_block", "to_block")
    reach = F.max("to_block").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("from_block") > reach + 1)).cast("long")
    numbered = ranges.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order))
    united = numbered.groupBy(*keys, "_island").agg(F.min("from_block").alias("from_block"), F.max("to_block").alias("to_block"))
    return united.drop("_island")


def merged(ranges: DataFrame, keys: list[str], span: int = SPAN_BLOCKS) -> DataFrame:
    """The fewest ranges with the same blocks: overlapping and touching ones united."""
    filled = ranges.where("from_block <= to_block").select(*keys, "from_block", "to_block")
    near = _islands(filled.withColumn("_span", F.floor(F.col("from_block") / span)), [*keys, "_span"])
    return _islands(near.drop("_span"), keys)


def covered(ranges: DataFrame, by: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``ranges`` whose blocks all lie in the union of ``by``.

    One pass over both sides in block order instead of a join by overlap: of
    disjoint islands only the last one begun can hold a range.
    """
    row = F.struct(*ranges.columns)
    sides = merged(by, keys).select(*keys, "from_block", "to_block", F.lit(0).alias("_asked"), F.lit(None).cast(ranges.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    sides = sides.unionByName(ranges.where("from_block <= to_block").select(*keys, "from_block", "to_block", F.lit(1).alias("_asked"), row.alias("_row")))
    begun = Window.partitionBy(*keys).orderBy("from_block", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("_asked") == 0, F.col("to_block"))).over(begun)
    return sides.withColumn("_reach", reach).where("_asked = 1 and to_block <= _reach").select("_row.*")


def uncovered(wanted: DataFrame, by: DataFrame, keys: list[str]) -> DataFrame:
    """The blocks of ``wanted`` outside ``by``, as the fewest ranges.

    Both sides become steps up and down at their bounds; where the running sum
    of the wanted side is up and the other one's is not, a piece is missing.
    """

    def steps(side: DataFrame, wants: int, has: int) -> DataFrame:
        bounds = F.array(
            F.struct(F.col("from_block").alias("_at"), F.lit(wants).alias("_wants"), F.lit(has).alias("_has")),
            F.struct((F.col("to_block") + 1).alias("_at"), F.lit(-wants).alias("_wants"), F.lit(-has).alias("_has")),
        )
        return merged(side, keys).select(*keys, F.inline(bounds))

    both = steps(wanted, 1, 0).unionByName(steps(by.select(*keys, "from_block", "to_block"), 0, 1))
    both = both.groupBy(*keys, "_at").agg(F.sum("_wants").alias("_wants"), F.sum("_has").alias("_has"))
    order = Window.partitionBy(*keys).orderBy("_at")
    here = both.withColumns(
        {"_wants": F.sum("_wants").over(order), "_has": F.sum("_has").over(order), "_next": F.lead("_at").over(order)}
    )
    pieces = here.where("_wants > 0 and _has = 0").select(*keys, F.col("_at").alias("from_block"), (F.col("_next") - 1).alias("to_block"))
    return merged(pieces, keys)
