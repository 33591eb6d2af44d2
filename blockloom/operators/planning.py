"""What to fetch next: resume points, block chunks, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CHUNK_BLOCKS, RETRY_DIVISOR, RETRY_MIN_BLOCKS
from .ranges import uncovered


def resume_blocks(table: DataFrame, address_column: str = "address") -> DataFrame:
    """Highest stored block per chain and contract."""
    return table.groupBy("chainid", F.lower(address_column).alias("address")).agg(
        F.max("block_number").alias("max_block")
    )


def high_water_marks(contracts: DataFrame, table: DataFrame, address_column: str = "address") -> DataFrame:
    """Highest stored block for each listed contract, 0 if nothing is stored."""
    marks = resume_blocks(table, address_column)
    asked = contracts.withColumn("address", F.lower("address"))
    joined = asked.join(marks, ["chainid", "address"], "left")
    return joined.withColumn("max_block", F.coalesce("max_block", F.lit(0).cast("bigint")))


def split_ranges(ranges: DataFrame, size: Column | int = CHUNK_BLOCKS) -> DataFrame:
    """One row per block window of each ``from_block``..``to_block`` range.

    An empty or unbounded range yields no row.
    """
    width = F.lit(size).cast("bigint") if isinstance(size, int) else size
    low, high = F.col("from_block"), F.col("to_block")
    starts = F.when(low <= high, F.sequence(low, high, width))
    windows = ranges.select("*", F.explode(starts).alias("chunk_start"))
    return windows.withColumn("chunk_end", F.least(F.col("chunk_start") + width - 1, high))


def fetch_plan(
    contracts: DataFrame,
    stored: DataFrame,
    latest: DataFrame,
    creations: DataFrame | None = None,
    kinds: tuple[str, ...] = ("logs", "transactions"),
    chunk_blocks: int = CHUNK_BLOCKS,
) -> DataFrame:
    """Block windows to request per contract and kind.

    ``contracts``: chainid, address, from_block, to_block (bounds may be
    NULL). ``stored``: chainid, address, kind, max_block, as from
    :func:`resume_blocks`. ``latest``: chainid, latest_block. The start is
    the stored maximum itself (its block may be incomplete; dedup removes
    the overlap), else the given bound, else creation, else 0.
    """
    known = _asked(contracts, creations, kinds).join(stored, ["chainid", "address", "kind"], "left")
    start = F.coalesce("max_block", "from_block", "creation_block", F.lit(0).cast("bigint"))
    return split_ranges(_bounded(known, start, latest), chunk_blocks)


def missing_plan(
    contracts: DataFrame,
    covered: DataFrame,
    latest: DataFrame,
    creations: DataFrame | None = None,
    kinds: tuple[str, ...] = ("logs", "transactions"),
    chunk_blocks: int = CHUNK_BLOCKS,
) -> DataFrame:
    """Block windows that no whole fetch covers, per contract and kind.

    Where :func:`fetch_plan` goes on at the highest stored block, this one
    finds the holes below it too. ``covered``: chainid, address, kind,
    from_block, to_block of ranges that are all there, as from the ledger's
    :func:`~blockloom.operators.writing.whole_ranges`. Wanted is all from the
    given bound, else creation, else 0, to the given bound, else the latest
    block.
    """
    keys = ["chainid", "address", "kind"]
    start = F.coalesce("from_block", "creation_block", F.lit(0).cast("bigint"))
    wanted = _bounded(_asked(contracts, creations, kinds), start, latest)
    have = covered.withColumn("address", F.lower("address"))
    # Of contracts nobody asks for nothing is sorted.
    have = have.join(wanted.select(*keys).distinct(), keys, "left_semi")
    return split_ranges(uncovered(wanted, have, keys), chunk_blocks)


def _asked(contracts: DataFrame, creations: DataFrame | None, kinds: tuple[str, ...]) -> DataFrame:
    """Contracts per kind of data, with their creation block."""
    asked = contracts.withColumn("address", F.lower("address"))
    if creations is not None:
        first = creations.groupBy("chainid", "address").agg(F.min("creation_block").alias("creation_block"))
        asked = asked.join(first, ["chainid", "address"], "left")
    else:
        asked = asked.withColumn("creation_block", F.lit(None).cast("bigint"))
    return asked.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))


def _bounded(asked: DataFrame, start: Column, latest: DataFrame) -> DataFrame:
    return asked.join(latest, "chainid", "left").select(
        "chainid",
        "address",
        "kind",
        start.alias("from_block"),
        F.coalesce("to_block", "latest_block").alias("to_block"),
    )


def retry_plan(failures: DataFrame) -> DataFrame:
    """Failed ranges in smaller windows: a tenth of the old size, at least 1,000."""
    size = F.greatest(
        F.floor(F.col("block_chunk_size") / RETRY_DIVISOR), F.lit(RETRY_MIN_BLOCKS)
    ).cast("bigint")
    return split_ranges(failures.withColumn("retry_size", size), F.col("retry_size"))


def page_slice(df: DataFrame, order: list[str | Column], page: int, rows: int) -> DataFrame:
    """Page ``page`` (from 1) of ``rows`` rows in the given order."""
    return df.orderBy(*order).offset((page - 1) * rows).limit(rows)


def page_after(df: DataFrame, order: list[str], last: tuple | None, rows: int) -> DataFrame:
    """The ``rows`` rows after the row with key ``last`` (None: the first page).

    Where :func:`page_slice` sorts and skips all earlier pages, this filters
    them out, so a deep page costs what the first one does.
    """
    if last is not None:
        after = F.lit(False)
        for n, column in enumerate(order):
            tied = F.lit(True)
            for before, value in zip(order[:n], last):
                tied = tied & (F.col(before) == F.lit(value))
            after = after | (tied & (F.col(column) > F.lit(last[n])))
        df = df.where(after)
    return df.orderBy(*order).limit(rows)


def in_chain_order(transactions: DataFrame, newest_first: bool = False) -> DataFrame:
    order = [F.col(c) for c in ("block_number", "transaction_index") if c in transactions.columns]
    return transactions.orderBy(*[c.desc() if newest_first else c.asc() for c in order])
