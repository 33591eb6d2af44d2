"""Data-quality checks as result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DECLARED, REQUIRED


def not_null(df: DataFrame, table: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """NULL counts of required columns, all in one pass over the table."""
    columns = columns or REQUIRED[table]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.inline(rows)).select(
        F.lit(table).alias("table"), "column", "violations", (F.col("violations") == 0).alias("passed")
    )


def declared_columns(df: DataFrame, table: str) -> DataFrame:
    """Declared and actual columns of a table side by side."""
    declared, actual = DECLARED[table], df.columns
    names = list(declared) + [c for c in actual if c not in declared]
    rows = [(table, n, n in declared, n in actual) for n in names]
    return df.sparkSession.createDataFrame(
        rows, "table string, column string, declared boolean, present boolean"
    )


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Declared and actual columns side by side, with the rows in which a
    column is filled: one pass over the table, NULL for a column it lacks."""
    names = declared_columns(df, table)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in df.columns])
    return names.join(F.broadcast(filled.select(F.inline(rows))), "column", "left").select("table", "column", "declared", "present", "filled")


def malformed_topics(logs: DataFrame) -> DataFrame:
    """Logs whose ``topics`` text is no JSON list; they cannot be decoded.
    Topics stored as an array are never malformed."""
    if isinstance(logs.schema["topics"].dataType, T.ArrayType):
        return logs.where(F.lit(False))
    return logs.where(F.col("topics").isNotNull() & F.from_json("topics", "array<string>").isNull())


def malformed_words(df: DataFrame, column: str) -> DataFrame:
    """Rows whose hex text has other characters and so no exact number."""
    return df.where(~F.lower(F.replace(F.col(column), F.lit("0x"), F.lit(""))).rlike("^[0-9a-f]*$"))
