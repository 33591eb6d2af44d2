"""Parquet layout, appends and catalog tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, stage, unstage
from ..sources.tables import BUCKET_BLOCKS, block_bucket
from .dedup import latest_by_key, new_by_key, new_rows, possible_copies
from .ranges import covered, merged

PARTITIONS = ["chainid", "block_bucket"]
#: Who a mark is kept for, where the table has the columns.
MARKED = ("chainid", "address")
#: Files below this size are worth packing.
FILE_BYTES = 64 * 1024 * 1024
LEDGER_KEYS = ["table", "contract_address", "chainid"]
BOUNDS = ["from_block", "to_block"]


def laid_out(df: DataFrame, sort: list[str], width: int = BUCKET_BLOCKS) -> DataFrame:
    """Rows grouped by chain and block bucket, sorted inside each task.

    ``rebalance`` lets AQE split a bucket that holds a third of all rows and
    merge tiny ones, so files come out even; the sort gives row groups narrow
    min/max ranges, which stand in for the warehouse's indexes.
    """
    bucketed = df.withColumn("block_bucket", block_bucket(F.col("block_number"), width))
    return bucketed.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *sort)


def write_table(df: DataFrame, path: str, sort: list[str], mode: str = "errorifexists", bloom: tuple[str, ...] = ()) -> int:
    """Partitioned Parquet; ``bloom`` columns get filters for point lookups.

    Returns the rows written, counted on the way in the writing tasks.
    """
    written = Observation()
    counted = laid_out(df, sort).observe(written, F.count(F.lit(1)).alias("n"))
    writer = counted.write.mode(mode).partitionBy(*PARTITIONS)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return written.get["n"]


def touched(table: DataFrame, fetched: DataFrame) -> DataFrame:
    """The table's partitions that ``fetched`` has rows for."""
    # One row per partition comes to the driver, as many as a listing of the folders has.
    return in_partitions(table, [tuple(r) for r in fetched.select(*PARTITIONS).distinct().collect()])


def in_partitions(table: DataFrame, partitions: list[tuple[int | None, int | None]]) -> DataFrame:
    """The rows of some (chainid, block_bucket), as literals that prune at planning time."""
    return table.where(in_partitions_of(partitions))


def in_partitions_of(partitions: list[tuple[int | None, int | None]]) -> Column:
    buckets: dict[int | None, list[int | None]] = {}
    for chain, bucket in partitions:
        buckets.setdefault(chain, []).append(bucket)
    wanted = F.lit(False)
    for chain, some in buckets.items():
        inside = F.col("block_bucket").isin([b for b in some if b is not None])
        if None in some:
            inside = F.coalesce(inside, F.lit(False)) | F.col("block_bucket").isNull()
        wanted = wanted | (F.col("chainid").eqNullSafe(F.lit(chain)) & inside)
    return F.coalesce(wanted, F.lit(False))


def append_new(
    fetched: DataFrame,
    path: str,
    sort: list[str],
    bloom: tuple[str, ...] = (),
    identity: tuple[list[str], list[str]] | None = None,
    staged: bool = False,
) -> int:
    """Append the fetched rows the table does not hold yet; returns how many.

    Only partitions with fetched rows that may be stored already are compared,
    and nothing stored is rewritten. Running the same append again adds no
    rows, so a job that failed half-way is simply run again. Rows are the same
    if all columns are, or with ``identity`` (keys, newest) if the keys are;
    of those fetched together the greatest by ``newest`` is taken.

    Beside the table, ``<path>_marks`` keeps how far each contract's blocks
    have been written. Rows beyond their contract's mark are new without a
    look at the table. Marks are written before the rows, so after a failure
    they are too high at most, which costs a comparison and loses nothing.
    A table that something else began has no marks and is always compared.
    Rows that are ``staged`` already are read several times from there.
    """
    spark = fetched.sparkSession
    bucketed = fetched.withColumn("block_bucket", block_bucket(F.col("block_number")))
    if not staged:
        kept = stage(bucketed, "fetched")
        added = _append(spark, kept, path, sort, bloom, identity)
        unstage(kept)
        return added
    return _append(spark, bucketed, path, sort, bloom, identity)


def _append(spark: SparkSession, staged: DataFrame, path: str, sort: list[str], bloom: tuple[str, ...], identity: tuple[list[str], list[str]] | None) -> int:
    stored = stored_table(spark, path, staged.schema)
    marks = _marks(spark, path) if stored is not None else None
    compared, rows, beyond = _to_compare(staged, marks)
    if stored is not None and not rows:
        return 0
    if stored is None or (marks is not None and beyond):
        _mark(staged, path)
    overlap = staged.limit(0) if stored is None else in_partitions(stored, compared)
    if identity is not None:
        fresh = new_by_key(staged, overlap, *identity)
    elif stored is None or not compared:
        fresh = staged.dropDuplicates()
    else:
        fresh = new_rows(staged, possible_copies(overlap, staged, rows))
    return write_table(fresh, path, sort, mode="append", bloom=bloom)


def _marked_by(df: DataFrame) -> list[str]:
    return [c for c in MARKED if c in df.columns]


def _marks(spark: SparkSession, path: str) -> DataFrame | None:
    marks = stored_table(spark, f"{path}_marks", None)
    if marks is None:
        return None
    return marks.groupBy(*[c for c in marks.columns if c != "max_block"]).agg(F.max("max_block").alias("max_block"))


def _mark(fetched: DataFrame, path: str) -> None:
    reached = fetched.groupBy(*_marked_by(fetched)).agg(F.max("block_number").alias("max_block"))
    reached.write.mode("append").parquet(f"{path}_marks")


def _to_compare(staged: DataFrame, marks: DataFrame | None) -> tuple[list[tuple], int, int]:
    """The partitions with rows that may be stored already, the fetched rows in
    all, and those beyond their contract's mark."""
    beyond = F.lit(False)
    rows = staged
    if marks is not None:
        keys = _marked_by(staged)
        m = marks.select(*[F.col(c).alias(f"_{c}") for c in keys], "max_block")
        rows = staged.join(m, _same({c: f"_{c}" for c in keys}), "left")
        beyond = F.coalesce(F.col("block_number") > F.coalesce("max_block", F.lit(-1)), F.lit(False))
    found = rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n"), F.count_if(~beyond).alias("known")).collect()
    rows, known = sum(r["n"] for r in found), sum(r["known"] for r in found)
    return [(r["chainid"], r["block_bucket"]) for r in found if r["known"]], rows, rows - known


def upsert(
    fetched: DataFrame,
    path: str,
    sort: list[str],
    identity: tuple[list[str], list[str]],
    bloom: tuple[str, ...] = (),
) -> int:
    """Keep one row per key, the newest of stored and fetched; returns how many keys are new.

    ``identity`` is (keys, newest): a stored row gives way to a fetched one
    that is greater by ``newest``, and stays if they are equal, so a refetch
    with nothing newer changes nothing. New keys are appended. Partitions with
    stored rows that give way are merged in the shared folder and put in place
    by :func:`replace_partitions`, which a lost driver cannot leave half done;
    others are not rewritten. Stored rows are only joined, never sorted.
    """
    spark = fetched.sparkSession
    finish_replacing(spark, path)
    keys, newest = identity
    bucketed = fetched.withColumn("block_bucket", block_bucket(F.col("block_number")))
    staged = stage(latest_by_key(bucketed, keys, newest), "fetched")
    stored = stored_table(spark, path, staged.schema)
    if stored is None:
        added = write_table(staged, path, sort, mode="append", bloom=bloom)
        unstage(staged)
        return added
    near = touched(stored, staged)
    held = _semi(near, staged, keys).groupBy(*keys)
    if len(newest) == 1:  # The greatest of one plain column needs no sorting.
        held = held.agg(F.max(newest[0]).alias(newest[0])).withColumn("_held", F.struct(*newest))
    else:
        held = held.agg(F.max(F.struct(*newest)).alias("_held"))
    held = held.select(*[F.col(c).alias(f"_{c}") for c in keys], "_held")
    same = _same({c: f"_{c}" for c in keys})
    judged = staged.join(held, same, "left").withColumn("_newer", F.struct(*newest) > F.col("_held"))
    judged = stage(judged.where("_held is null or _newer").select(*staged.columns, F.col("_held").isNull().alias("_new")), "newer")
    newer = judged.where("not _new")
    replaced = [tuple(r) for r in _semi(near, newer, keys).select(*PARTITIONS).distinct().collect()]
    if replaced:
        kept = _semi(in_partitions(near, replaced), newer, keys, "left_anti").select(*staged.columns)
        replace_partitions(kept.unionByName(in_partitions(judged, replaced).drop("_new")), path, sort, bloom)
        rest = judged.where(~in_partitions_of(replaced))
    else:
        rest = judged
    write_table(rest.drop("_new"), path, sort, mode="append", bloom=bloom)
    added = judged.where("_new").count()
    unstage(staged)
    unstage(judged)
    return added


def _same(columns: dict[str, str]) -> Column:
    same = F.lit(True)
    for a, b in columns.items():
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def _semi(rows: DataFrame, some: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose keys, NULLs included, are among those of ``some`` or are not."""
    others = some.select(*[F.col(c).alias(f"_{c}") for c in keys])
    return rows.join(others, _same({c: f"_{c}" for c in keys}), how)


def replace_partitions(rows: DataFrame, path: str, sort: list[str], bloom: tuple[str, ...] = ()) -> None:
    """Put ``rows``, all there is of their partitions, in the place of what is stored.

    The new rows are complete in the shared folder, and a note beside the
    table names them, before a stored file goes. If the job is lost while
    partitions change places, :func:`finish_replacing` does it over from there.
    """
    spark = rows.sparkSession
    staged = stage(rows, "replacing")
    place = staged.inputFiles()[0].rsplit("/", 1)[0]
    note = spark.createDataFrame([(place, sort, list(bloom))], "place string, sort array<string>, bloom array<string>")
    note.write.mode("overwrite").parquet(f"{path}_replacing")
    finish_replacing(spark, path)


def finish_replacing(spark: SparkSession, path: str) -> bool:
    """Complete a replacement that has begun; True if there was one."""
    note = stored_table(spark, f"{path}_replacing", None)
    found = note.first() if note is not None else None
    if found is None:
        return False
    staged = spark.read.parquet(found["place"])
    writer = staged.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *found["sort"]).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS)
    for column in found["bloom"]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    delete_path(spark, f"{path}_replacing")
    unstage(staged)
    return True


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """(chainid, block_bucket, files, bytes, small_files) per partition, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.groupBy(*[F.col(c).cast("bigint").alias(c) for c in PARTITIONS]).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.count_if(F.col("length") < FILE_BYTES).alias("small_files")
    )


def compact(
    spark: SparkSession,
    path: str,
    sort: list[str],
    bloom: tuple[str, ...] = (),
    partitions: list[tuple] | None = None,
    most_small: int = 1,
) -> int:
    """Pack the partitions that appends have left in more than ``most_small``
    small files; returns how many there were.

    A partition's rows go into as few sorted files as their size asks for. The
    packed rows are compared with the stored ones by count and by the sum of
    their hashes before they are put in place like those of an upsert.
    ``partitions`` (chainid, block_bucket) limits the work to those that a
    load has touched. Only the listing tells which are worth it.
    """
    finish_replacing(spark, path)
    found = partition_files(spark, path).where(F.col("small_files") > most_small)
    if partitions is not None:
        found = found.where(in_partitions_of(partitions))
    worth = [(r["chainid"], r["block_bucket"]) for r in found.collect()]
    if not worth:
        return 0
    stored = in_partitions(spark.read.parquet(path), worth)
    packed = stage(stored.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *sort), "packed")
    before, after = _fingerprint(stored), _fingerprint(packed)
    if before != after:
        raise RuntimeError(f"packed rows differ from the stored ones: {after} instead of {before}")
    replace_partitions(packed, path, sort, bloom)
    unstage(packed)
    return len(worth)


def _fingerprint(df: DataFrame) -> tuple:
    """Row count and a sum of row hashes, the same in any order."""
    hashed = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return tuple(df.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def stored_table(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """The table at ``path``, or None before the first write."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def save_model(df: DataFrame, name: str, sort: list[str], bloom: tuple[str, ...] = ()) -> DataFrame:
    """Replace a catalog table, laid out like the raw tables; returns it."""
    writer = laid_out(df, sort).write.mode("overwrite").format("parquet").partitionBy(*PARTITIONS)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _record(ranges: DataFrame, path: str, status: str) -> None:
    """Append ranges to the ledger, stamped with the time."""
    ranges.select(
        F.current_timestamp().alias("timestamp"),
        "table",
        "contract_address",
        "chainid",
        "from_block",
        "to_block",
        "block_chunk_size",
        F.lit(status).alias("status"),
    ).write.mode("append").parquet(path)


def record_failures(failures: DataFrame, path: str) -> None:
    """Append failed ranges to the ledger; they are open until something settles them."""
    _record(failures, path, "open")


def record_whole(ranges: DataFrame, path: str) -> None:
    """Append ranges of which every page came well."""
    _record(ranges, path, "whole")


def resolve_failures(resolved: DataFrame, path: str) -> None:
    """Mark ranges as retried: an appended row, the newest status of a range wins."""
    _record(resolved, path, "resolved")


def _newest_entries(ledger: DataFrame) -> DataFrame:
    newest = ledger.groupBy(*LEDGER_KEYS, *BOUNDS).agg(F.max(F.struct("timestamp", "status", "block_chunk_size")).alias("_last"))
    return newest.select(*LEDGER_KEYS, *BOUNDS, "_last.status", "_last.block_chunk_size")


def open_failures(ledger: DataFrame) -> DataFrame:
    """Ranges whose newest entry is still open."""
    return _newest_entries(ledger).where("status = 'open'").drop("status")


def whole_ranges(ledger: DataFrame) -> DataFrame:
    """The blocks of which all is there, per table, contract and chain, as the fewest ranges."""
    return merged(_newest_entries(ledger).where("status = 'whole'"), LEDGER_KEYS)


def settled_failures(ledger: DataFrame) -> DataFrame:
    """Open ranges that whole ranges cover together, whatever windows a retry cut them into."""
    newest = _newest_entries(ledger)
    still = newest.where("status = 'open'").drop("status")
    # Contracts without an open range need no sorting.
    whole = _semi(newest.where("status = 'whole'"), still, LEDGER_KEYS)
    return covered(still, whole, LEDGER_KEYS)
