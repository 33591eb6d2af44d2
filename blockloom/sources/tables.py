"""Raw tables: partitioned Parquet, catalog tables, and an optional JDBC edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BLOCKS = 100_000


def block_bucket(block: Column, width: int = BUCKET_BLOCKS) -> Column:
    return F.floor(block / F.lit(width)).cast("bigint")


def read_range(
    table: DataFrame,
    from_block: int | None = None,
    to_block: int | None = None,
    address: str | None = None,
    address_column: str = "address",
    width: int = BUCKET_BLOCKS,
) -> DataFrame:
    """Rows of a block range and contract.

    The bounds are repeated on the ``block_bucket`` partition where the table
    has one, so whole folders drop out before any file is opened; the rest of
    the predicate reaches the Parquet row groups.
    """
    partitioned = "block_bucket" in table.columns
    if from_block is not None:
        table = table.where(F.col("block_number") >= from_block)
        if partitioned:
            table = table.where(F.col("block_bucket") >= from_block // width)
    if to_block is not None:
        table = table.where(F.col("block_number") <= to_block)
        if partitioned:
            table = table.where(F.col("block_bucket") <= to_block // width)
    if address is not None:
        # Loaded addresses are lower case; other tables may hold the one that was given.
        asked = sorted({address, address.lower()})
        column = F.col(address_column)
        table = table.where(column == asked[0] if len(asked) == 1 else column.isin(asked))
    return table


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input with fewer splits than cores.

    Matters for a single small file followed by parsing; a large input has
    more splits than cores and passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(spark: SparkSession, name: str) -> int:
    """Rows of a catalog table, 0 if it does not exist."""
    return spark.table(name).count() if table_exists(spark, name) else 0


def stored_extent(spark: SparkSession, path: str, partitions: tuple[str, ...] = ("chainid", "block_bucket")) -> DataFrame:
    """Rows and first and last block of each partition of a Parquet table,
    from the files' footers: no row is read.

    Counts and bounds are pushed into the newer Parquet reader, which a session
    of its own switches on. One row per partition comes back through the driver.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = extent_of(own.read.parquet(path), partitions)
    types = {f.name: f.dataType.simpleString() for f in found.schema}
    return spark.createDataFrame([tuple(r) for r in found.collect()], ", ".join(f"{n} {t}" for n, t in types.items()))


def extent_of(table: DataFrame, partitions: tuple[str, ...] = ("chainid", "block_bucket")) -> DataFrame:
    return table.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("rows"), F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block")
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    parts: int,
    **properties: str,
) -> DataFrame:
    """A database table in ``parts`` range queries instead of one connection."""
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=parts,
        properties=properties,
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, **properties: str) -> None:
    """``connections`` caps the parallel writers the database sees."""
    writer = df.write.option("numPartitions", connections).option("batchsize", 10_000)
    writer.jdbc(url, table, mode=mode, properties=properties)
