"""Fill-in-the-middle texts, cut at line borders.

A text's units are its lines, each with its line feed. One ``fullmatch`` of
the repeated unit keeps every repetition of its group, so the group's ends
give the number of units and the places of both cuts at once.

Which units the cuts fall on, and the order of the parts, come from a hash of
the document's id, so that a rerun cuts alike. ``psm`` puts the middle behind
prefix and suffix, ``spm`` begins with the suffix. A text that holds a marker
itself stays as it is (``plain``), so markers in an output are always ours and
:func:`restored` gets the exact text back from output and form alone.

Nulls and ties: a null text counts as empty; an empty text is plain and has no
units. A null doc_id is hashed as an empty number. Rows of one doc_id have the
same hash; repeated rows are cut alike, each on its own. A text without a line
feed is one unit, whatever its length. An empty table gives an empty result;
columns named as those added are replaced, others pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Texts of a hundred that are cut, and those of a hundred cut ones that begin with the suffix.
CUT, SUFFIX_FIRST = 100, 50

_UNITS = r"([^\n]*\n|[^\n]+)*"
ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def _numbers(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """The first four groups of eight digits of the id's hash."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in range(0, 32, 8))


def cut(units: regex.Pattern, text: str, h: tuple[int, ...], share: int = CUT, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= share:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    # No unit before the cut: it lies at the start.
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def transformed(docs: DataFrame, seed: int = SEED, share: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` with ``output``, its ``form``, and where it was cut."""
    docs = docs.drop(*ADDED.fieldNames())
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, types = regex.compile(_UNITS), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for whole in batches:
            # A few texts at a time, as outputs are as long as texts.
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts, ids = batch.column(names.index("text")), batch.column(names.index("doc_id"))
                rows = [cut(units, t.as_py() or "", _numbers(i.as_py(), seed), share, suffix_first) for t, i in zip(texts, ids)]
                added = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.

    Markers stand only where they were put, so each part ends at the first
    marker that can follow it.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(second: str) -> tuple[Column, Column, Column]:
        first = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(first) + len(second) + 1)
        middle = F.substring_index(rest, MIDDLE, 1)
        return first, middle, F.substr(rest, F.length(middle) + len(MIDDLE) + 1)

    prefix, suffix, moved = parts(SUFFIX)
    after, before, inner = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, moved, suffix))
        .when(form == "spm", F.concat(before, inner, after))
        .otherwise(output)
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transformed(table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def _group(k: int) -> str:
    return f"('0x' || substr(h, {8 * k + 1}, 8))::bigint"


OP13_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u from documents),
n as (
  select *, len(u)::bigint as n, t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}')
    or {_group(2)} % 100 >= {CUT} as plain, {_group(0)} % (len(u) + 1) as a, {_group(1)} % (len(u) + 1) as b from d),
p as (
  select *, array_to_string(u[1 : least(a, b)], '') as prefix, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') as middle,
    array_to_string(u[greatest(a, b) + 1 :], '') as suffix,
    case when plain then 'plain' when {_group(3)} % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form from n)
select doc_id, n, form, case when not plain then length(prefix) end as prefix_chars, case when not plain then length(middle) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end) as output_sha256, sha256(t) as restored_sha256
from p
"""
