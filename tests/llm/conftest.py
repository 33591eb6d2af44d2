from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang, source]) as a table of documents."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


#: Nulls in any column, empty and blank texts, long texts, ties, repeated rows.
AWKWARD = [
    (1, "the old man and the sea went out again", "en", "a"),
    (2, "the  old man\tand the sea\nwent out again", "en", "a"),
    (3, "THE OLD MAN AND THE SEA WENT OUT AGAIN", None, None),
    (4, "", "en", "b"),
    (5, None, "en", "b"),
    (6, "   \n\t ", None, "c"),
    (7, "x", "de", "c"),
    (7, "x", "de", "c"),
    (7, "another text under the same id", "de", "c"),
    (None, "a row without an id", "en", None),
    (None, None, None, None),
    (8, "lorem ipsum " * 20_000, "la", "a"),
    (9, "12 34 56 !? --", "en", "d"),
    (10, "émotion naïve ÀÉ ß 日本語 ①", "fr", "d"),
]


@pytest.fixture
def awkward():
    return list(AWKWARD)


@pytest.fixture
def crowded(spark):
    """Columns beside those of documents, with names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["score", "ids", "decoded", "rank", "size", "n", "at", "name", "level", "rows", "key", "node", "token", "label", "copies", "lang_pred", "text_hash", "source_size", "target"]
    return lambda df: df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
