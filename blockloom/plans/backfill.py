"""Landing files to tables, with failed and incomplete ranges kept for retry."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHUNK_BLOCKS, PAGE_ROWS
from ..operators.lookups import with_chain_id
from ..operators.writing import (
    LEDGER_KEYS,
    PARTITIONS,
    append_new,
    record_failures,
    record_whole,
    resolve_failures,
    settled_failures,
    stored_table,
    touched,
    upsert,
)
from ..schemas import RAW_LOG, RAW_TRANSACTION
from ..session import stage, unstage
from ..sources.landing import (
    RANGE,
    incomplete_ranges,
    merged_state,
    opened_pages,
    opened_state,
    range_state,
    read_pages,
    typed_elements,
)
from ..sources.tables import block_bucket

SORT = {"logs": ["address", "block_number", "log_index"], "transactions": ["address", "block_number"]}
BLOOM = {"logs": ("transaction_hash",), "transactions": ("hash",)}
#: What makes a transaction the same one fetched again, and which fetch is the newest; logs are the same in all columns.
IDENTITY = {"transactions": (["chainid", "address", "hash"], ["confirmations"])}
ELEMENT = {"logs": RAW_LOG, "transactions": RAW_TRANSACTION}
#: What is kept of each page that was taken in.
STATE = T.StructType(
    [
        *[T.StructField(c, T.LongType() if c.endswith("block") else T.StringType()) for c in RANGE],
        T.StructField("page", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("chainid", T.LongType()),
        T.StructField("block_bucket", T.LongType()),
    ]
)
LANDED = "path string, modified timestamp, kind string"


@dataclass(frozen=True)
class Load:
    rows_added: int
    failed_ranges: int


def failed_ranges(pages: DataFrame, kind: str, page_rows: int = PAGE_ROWS, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """Ranges to fetch again: a page was rejected, missing, malformed, or the last one full.

    The chunk size is the width that was asked for, so a retry of a retry
    shrinks further. Ranges of unknown chains stay, with a NULL chainid.
    """
    return _ledger_rows(incomplete_ranges(pages, page_rows, ELEMENT[kind]), kind, chunk_blocks)


def _ledger_rows(ranges: DataFrame, kind: str, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    width = F.least(F.col("to_block") - F.col("from_block") + 1, F.lit(chunk_blocks))
    return with_chain_id(ranges, how="left").select(
        F.lit(kind).alias("table"),
        F.lower("address").alias("contract_address"),
        "chainid",
        "from_block",
        "to_block",
        F.coalesce(width, F.lit(chunk_blocks)).cast("bigint").alias("block_chunk_size"),
    )


def new_files(spark: SparkSession, landing: str, ledger: str, kind: str) -> DataFrame:
    """(path, modified, kind) of landed files that no load has taken in yet.

    From the folder's listing: no file is opened. A file that was written
    again counts as new; its pages are the same ones fetched again.
    """
    listed = spark.read.format("binaryFile").load(landing).select("path", F.col("modificationTime").alias("modified"), F.lit(kind).alias("kind"))
    done = stored_table(spark, f"{ledger}_files", spark.createDataFrame([], LANDED).schema)
    return listed if done is None else listed.join(done, ["path", "modified", "kind"], "left_anti")


def load_landing(spark: SparkSession, landing: str, table: str, ledger: str, kind: str = "logs", page_rows: int = PAGE_ROWS) -> Load:
    """Take in what newly landed: rows to the table, failures to the ledger.

    Only new files are opened, however many older ones there are. Their names
    are kept beside the ledger when all they hold is stored, so a load that
    failed half-way is simply run again.
    """
    files = stage(new_files(spark, landing, ledger, kind), "files")
    # The names of the new files alone come to the driver, where a scan of them is planned.
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return Load(0, 0)
    found = load_pages(read_pages(spark, [_literal(p) for p in paths]), table, ledger, kind, page_rows)
    files.write.mode("append").parquet(f"{ledger}_files")
    unstage(files)
    return found


def _literal(path: str) -> str:
    """A path none of whose characters is taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def load_pages(pages: DataFrame, table: str, ledger: str, kind: str = "logs", page_rows: int = PAGE_ROWS) -> Load:
    """Take in pages, those of a folder or of a stream's micro-batch.

    The pages' JSON is read once, for rows and state. Each page leaves one row of state beside the ledger. The ranges that the
    pages belong to are judged by that state, old pages included, which is
    read from the partitions of these ranges alone. Ranges with a page that is
    refused, missing or malformed are ledgered as open, the others as whole,
    and open ranges that whole ones cover together are settled. All of it can
    be run again: state merges, and the newest entry of a range counts.
    """
    opened = stage(typed_elements(opened_pages(pages, ELEMENT[kind]), kind), "opened")
    rows = opened.where("_page.sound").drop("_page")
    if kind == "logs":
        added = append_new(rows, table, SORT[kind], BLOOM[kind], staged=True)
    else:
        added = upsert(rows, table, SORT[kind], IDENTITY[kind], BLOOM[kind])
    state = with_chain_id(merged_state(opened_state(opened).withColumn("address", F.lower("address"))), how="left")
    state = state.withColumns({"kind": F.lit(kind), "block_bucket": block_bucket(F.col("from_block"))}).select(STATE.fieldNames())
    state = stage(state, "page-state")
    state.write.mode("append").partitionBy("kind", *PARTITIONS).parquet(f"{ledger}_pages")

    asked = stage(state.select(*RANGE, *PARTITIONS).distinct(), "ranges")
    old = touched(stored_table(pages.sparkSession, f"{ledger}_pages", STATE).where(F.col("kind") == kind), asked)
    judged = stage(range_state(merged_state(_of_ranges(old, asked)), page_rows), "judged")
    failures = judged.where(~F.coalesce("complete", F.lit(False)))
    failed = failures.count()
    if failed:
        record_failures(_ledger_rows(failures, kind), ledger)
    record_whole(_ledger_rows(judged.where("complete"), kind), ledger)
    entries = stored_table(pages.sparkSession, ledger, None)
    settled = stage(settled_failures(_of_contracts(entries, _ledger_rows(judged, kind))), "settled")
    if not settled.isEmpty():
        resolve_failures(settled, ledger)
    for part in (opened, state, asked, judged, settled):
        unstage(part)
    return Load(added, failed)


def _of_ranges(state: DataFrame, ranges: DataFrame) -> DataFrame:
    asked = ranges.select(*[F.col(c).alias(f"_{c}") for c in RANGE])
    return state.join(asked, _null_safe(RANGE), "left_semi")


def _of_contracts(entries: DataFrame, ranges: DataFrame) -> DataFrame:
    asked = ranges.select(*[F.col(c).alias(f"_{c}") for c in LEDGER_KEYS]).distinct()
    return entries.join(asked, _null_safe(LEDGER_KEYS), "left_semi")


def _null_safe(columns) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same
