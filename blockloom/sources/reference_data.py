"""Small reference inputs: chains, contract manifest, ABIs, proxy pairs."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHAIN_IDS
from ..functions import lower_address
from ..schemas import abi_entry


def chains(spark: SparkSession) -> DataFrame:
    """chain, chainid: fixed, 71 rows."""
    return spark.createDataFrame(list(CHAIN_IDS.items()), "chain string, chainid bigint")


def chain_id(chain: str | None = None, chainid: int | None = None) -> int:
    """Chain id from exactly one of name or id."""
    if (chain is None) == (chainid is None):
        raise ValueError("give exactly one of chain and chainid")
    if chainid is not None:
        return chainid
    if chain not in CHAIN_IDS:
        raise ValueError(f"unknown chain {chain!r}; known: {', '.join(sorted(CHAIN_IDS))}")
    return CHAIN_IDS[chain]


def chains_from_json(texts: DataFrame) -> DataFrame:
    """A chain file of one's own: a JSON object of name to id in column ``value``."""
    return texts.select(F.explode(F.from_json("value", "map<string,bigint>")).alias("chain", "chainid"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_from_text(spark.read.text(path, wholetext=True))


def manifest_from_text(texts: DataFrame) -> DataFrame:
    """name, address, chain from a JSON object of contracts in column ``value``."""
    parsed = F.from_json("value", "map<string,struct<address:string,chain:string>>")
    return texts.select(F.explode(parsed).alias("name", "_c")).select(
        "name", lower_address(F.col("_c.address")).alias("address"), "_c.chain"
    )


def abi_files(spark: SparkSession, folder: str) -> DataFrame:
    """ABI entries of a folder holding one ``<address>.json`` per contract."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), "([^/]+)[.]json$", 1)
    return abi_entries(files.select(name.alias("address"), "value"))


def _depth(parts: object) -> int:
    """Levels of parameters: 1 without tuples, one more for members of members."""
    if not isinstance(parts, list):
        return 0
    return 1 + max((_depth(p.get("components")) for p in parts if isinstance(p, dict)), default=0)


@F.arrow_udf(T.IntegerType())
def _abi_depth(texts: pa.Array) -> pa.Array:
    depths = []
    for text in texts.to_pylist():
        try:
            entries = json.loads(text or "[]")
        except ValueError:
            entries = []
        entries = [e for e in entries if isinstance(e, dict)] if isinstance(entries, list) else []
        depths.append(max((_depth(e.get("inputs")) for e in entries), default=0))
    return pa.array(depths, type=pa.int32())


def abi_entries(texts: DataFrame) -> DataFrame:
    """One row per ABI entry of ``(address, value)`` with the list as JSON text.

    The schema is as deep as the tuples in the input, which one pass over the
    texts finds out beforehand.
    """
    depth = texts.agg(F.max(_abi_depth(F.col("value")))).first()[0] or 1
    parsed = F.from_json("value", T.ArrayType(abi_entry(max(depth, 1))))
    return texts.select(lower_address(F.col("address")).alias("address"), F.explode(parsed).alias("entry"))


def proxy_pairs(spark: SparkSession, path: str) -> DataFrame:
    """address, implementation_address and where they stand, from CSV with a header."""
    schema = "address string, implementation_address string"
    pairs = spark.read.schema(schema).csv(path, header=True)
    lowered = {c: lower_address(F.col(c)) for c in ("address", "implementation_address")}
    # Lines of a split are numbered upwards; files go by name.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return merge_proxy_pairs(pairs.select("*", place.alias("position")).withColumns(lowered))


def merge_proxy_pairs(*parts: DataFrame) -> DataFrame:
    """Appended pairs without duplicates; of equal ones the first position stays, if there are positions."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    if "position" not in merged.columns:
        return merged.dropDuplicates()
    return merged.groupBy("address", "implementation_address").agg(F.min("position").alias("position"))
