"""Chain names and ids, creation blocks, proxies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lower_address
from ..sources.reference_data import chains


def with_chain_id(df: DataFrame, name_column: str = "chain", how: str = "inner") -> DataFrame:
    """Add ``chainid``; rows of unknown chains drop out (see
    :func:`unknown_chains`), or get NULL with ``how="left"``."""
    known = chains(df.sparkSession).withColumnRenamed("chain", name_column)
    return df.join(F.broadcast(known), name_column, how)


def unknown_chains(df: DataFrame, name_column: str = "chain") -> DataFrame:
    known = chains(df.sparkSession).withColumnRenamed("chain", name_column)
    return df.join(F.broadcast(known), name_column, "left_anti")


def with_chain_name(df: DataFrame, name_column: str = "chain") -> DataFrame:
    """Add the chain's name by ``chainid``, ``unknown`` if there is none."""
    known = chains(df.sparkSession).withColumnRenamed("chain", "_name")
    named = df.join(F.broadcast(known), "chainid", "left")
    return named.withColumn(name_column, F.coalesce("_name", F.lit("unknown"))).drop("_name")


def first_implementation(pairs: DataFrame) -> DataFrame:
    """One implementation per proxy: the first on file, or the smallest if no
    ``position`` tells which that is."""
    stated = pairs.where("implementation_address is not null and lower(implementation_address) <> 'none'").select(
        lower_address(F.col("address")).alias("address"),
        lower_address(F.col("implementation_address")).alias("implementation_address"),
        *(["position"] if "position" in pairs.columns else []),
    )
    if "position" in stated.columns:
        first = F.min_by("implementation_address", F.struct("position", "implementation_address"))
    else:
        first = F.min("implementation_address")
    return stated.groupBy("address").agg(first.alias("implementation_address"))


def with_implementation(contracts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add ``implementation_address``, NULL for contracts that are no proxy."""
    asked = contracts.withColumn("address", lower_address(F.col("address")))
    return asked.join(first_implementation(pairs), "address", "left")


def with_creation_block(contracts: DataFrame, creations: DataFrame) -> DataFrame:
    """Fill a missing ``from_block`` with the contract's creation block."""
    first = creations.groupBy("chainid", "address").agg(F.min("creation_block").alias("_created"))
    joined = contracts.join(first, ["chainid", "address"], "left")
    return joined.withColumn("from_block", F.coalesce("from_block", "_created")).drop("_created")
