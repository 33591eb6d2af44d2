"""A corpus pipeline: five stages, each one of the operators of ``blockloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again for the next one. All
stages but the last return the columns of documents.

Nulls and ties: a document goes in the first stage if its text is null, has no
letter or is in no learned language; if there is none to learn, the first two
kinds go. Null ids are larger than any other and null
sources are a source. Of equal texts, and of near copies, the smallest id
stays; of rows that repeat an id and a text, the least row by all columns.
Rows that are equal altogether share their copies in the mix. An empty table
goes through all stages as one, and columns beside those of documents,
whatever their names, pass to the end.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockloom.llm import exact_dedup, jaccard, language, mixing, pieces  # noqa: E402
from blockloom.session import stage  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language's profile is closer to than chance go."""
    return language.known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8 or more."""
    return jaccard.representatives(docs, words=5, least=(80, 100))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids and the text decoded from them."""
    return pieces.encode(docs, decoded="decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: Language profiles, signature trees and pieces are not SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
