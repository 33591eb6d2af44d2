"""Landing files to a deduplicated table as a stream.

A micro-batch meets two filters. Rows that came within the last ``remember``
are known to the stream's keyed state, so pages fetched twice in a short time
go no further. What is left goes through the same append as a batch load: rows
beyond what their contract has stored are new without a look at the table,
older ones are compared with the partitions they belong to. No row is too
late, in whatever order blocks land, and a batch that runs again after a
failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import PAGE_ROWS
from ..operators.writing import append_new, stored_table
from ..plans.backfill import Load, load_pages
from ..session import SETTINGS, stage, unstage

REMEMBER = "1 day"
BATCHES = "checkpoint string, batch long"
#: Every partition of a query's state is saved by itself with each batch, so
#: there are two a core and not the session's shuffle partitions, if these are
#: more; a checkpoint keeps the number it began with.
SHUFFLES, LEAST_STORES = "spark.sql.shuffle.partitions", 32
#: Streams keep their state so in any session, whoever built it.
STREAM_SETTINGS = {name: value for name, value in SETTINGS.items() if name.startswith("spark.sql.streaming.")}


def unseen(rows: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """Rows of a stream that have not come within the last ``remember``.

    The state's clock is the time of arrival, not of the block, so that no row
    is ever behind the watermark; state goes after ``remember``, and what comes
    again later is left to the append. A row's key is the hash of all its
    columns beside those that name it.
    """
    named = [c for c in ("chainid", "transaction_hash", "hash", "log_index") if c in rows.columns]
    keyed = rows.withColumns({"_row": F.xxhash64(*rows.columns), "_arrived": F.current_timestamp()})
    keyed = keyed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["_row", *named])
    return keyed.drop("_row", "_arrived")


def append_available(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    sort: list[str],
    bloom: tuple[str, ...] = (),
    identity: tuple[list[str], list[str]] | None = None,
    each: Callable[[DataFrame], DataFrame] | None = None,
    remember: str | None = REMEMBER,
) -> StreamingQuery:
    """Process everything that has landed, append what is new, stop.

    ``rows`` need chainid and block_number. ``each`` is applied to a
    micro-batch before the append. ``checkpoint`` is the resume point: a rerun
    with it takes only new files. Without ``remember`` no state is kept.

    A query with state runs without adaptive execution, and so does all that
    is asked of its batches. Only the batch itself is written that way; the
    append reads it in the session of ``rows``, where the number of tasks and
    of files goes by the size of the data.
    """
    spark = rows.sparkSession

    def append(batch: DataFrame, _: int) -> None:
        staged = stage(each(batch) if each else batch, "batch", spark)
        append_new(staged, table, sort, bloom, identity, staged=True)
        unstage(staged)

    return _run(unseen(rows, remember) if remember else rows, append, checkpoint)


def load_available(
    pages: DataFrame,
    table: str,
    ledger: str,
    checkpoint: str,
    kind: str = "logs",
    page_rows: int = PAGE_ROWS,
    done: Callable[[Load], None] | None = None,
) -> StreamingQuery:
    """Take in all pages that have landed as :func:`backfill.load_pages` does
    with a folder: rows to the table, failures to the ledger.

    A micro-batch has both outputs. Its number is kept beside the ledger when
    both are written; one that runs again after that is passed over, one that
    was lost half-way is done over, which changes neither. ``done`` is told
    what each micro-batch came to.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        this = spark.createDataFrame([(checkpoint, number)], BATCHES)
        before = stored_table(spark, f"{ledger}_batches", this.schema)
        if before is not None and not before.join(this, ["checkpoint", "batch"], "left_semi").isEmpty():
            return
        found = load_pages(batch, table, ledger, kind, page_rows)
        this.coalesce(1).write.mode("append").parquet(f"{ledger}_batches")
        if done:
            done(found)

    return _run(pages, load, checkpoint)


def _run(rows: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    # A query copies the session's settings when it starts.
    conf = rows.sparkSession.conf
    stores = max(LEAST_STORES, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    settings = STREAM_SETTINGS | {SHUFFLES: str(min(int(conf.get(SHUFFLES)), stores))}
    before = {name: conf.get(name, None) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        query = rows.writeStream.foreachBatch(function).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    query.awaitTermination()
    return query
