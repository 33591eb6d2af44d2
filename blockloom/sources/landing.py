"""Landed explorer API pages: one JSON envelope per line, batch or stream.

Every function after the reader takes and returns DataFrames, so the same
code runs under ``spark.read`` and ``spark.readStream``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHAIN_IDS, NUMERIC_FIELDS, PAGE_ROWS
from ..functions import lower_address, once, parse_number, parse_wide_number, with_0x
from ..schemas import (
    CREATION,
    ENVELOPE,
    LOG_COLUMNS,
    RAW_LOG,
    RAW_TRANSACTION,
    RECEIPT,
    SNAKE_CASE,
    SOURCE_CODE,
)

WIDE_FIELDS = ("value", "gas")
#: What a page answers: the range that was asked for.
RANGE = ("address", "chain", "from_block", "to_block")


def read_pages(spark: SparkSession, path: str | list[str], schema: T.StructType = ENVELOPE) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stream_pages(
    spark: SparkSession, path: str, schema: T.StructType = ENVELOPE, files_per_trigger: int = 1000
) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


#: Member that keeps an element's text where its JSON does not fit the schema.
_BROKEN = "_broken"


def _chain_id(chain: Column) -> Column:
    """Chain id by name; the 71 names are fixed, so a literal map needs no join."""
    pairs = [F.lit(v) for name, number in CHAIN_IDS.items() for v in (name, number)]
    return F.try_element_at(F.create_map(*pairs), chain).cast("bigint")


def _element_texts() -> Column:
    """The result's elements as JSON text, NULL if it is no whole JSON list."""
    return F.when(F.ltrim("result").startswith("["), F.from_json("result", "array<string>"))


def _failed() -> Column:
    """An error is reported; an empty list under status 0 is the end of paging, not one."""
    is_empty = F.coalesce(F.col("result").rlike(r"^\s*\[\s*\]\s*$"), F.lit(False))
    return F.coalesce(F.col("status") == "0", F.lit(False)) & ~is_empty


def _error_kind(pages: DataFrame, texts: Column | None = None) -> Column:
    """Why a page cannot be used, NULL for good ones; ``texts`` are its elements, if read already."""
    texts = _element_texts() if texts is None else texts
    message = F.lower(F.coalesce("message", F.lit("API error")))
    kind = (
        F.when(_failed() & message.contains("rate limit"), "rate_limit")
        .when(_failed(), "api_error")
        .when(texts.isNull(), "malformed_result")
    )
    if "chain" in pages.columns:
        kind = kind.when(_chain_id(F.col("chain")).isNull(), "unknown_chain")
    return kind


def good_pages(pages: DataFrame) -> DataFrame:
    """Pages of known chains whose envelope reports success and whose result is a whole list."""
    return pages.where(_error_kind(pages).isNull())


def rejected_pages(pages: DataFrame) -> DataFrame:
    """The other pages, with ``error_kind`` telling rate limits apart."""
    message = F.coalesce("message", F.lit("API error"))
    return pages.withColumn("error_kind", _error_kind(pages)).where("error_kind is not null").withColumn(
        "message", F.when(_failed(), message).otherwise(F.col("message"))
    )


def _parsed(text: Column, element: T.StructType) -> Column:
    checked = T.StructType([*element.fields, T.StructField(_BROKEN, T.StringType())])
    return F.from_json(text, checked, {"columnNameOfCorruptRecord": _BROKEN})


def _is_broken(row: Column) -> Column:
    return row.isNull() | row[_BROKEN].isNotNull()


def _elements(pages: DataFrame, element: T.StructType, keep: list[str]) -> DataFrame:
    """One row per sound result element; a page holds a bounded number of them."""
    read = pages.withColumn("_texts", once(_element_texts()))
    texts = read.where(_error_kind(read, F.col("_texts")).isNull()).select(*keep, F.explode("_texts").alias("_text"))
    rows = texts.select(*keep, once(_parsed(F.col("_text"), element)).alias("_row"))
    return rows.where(~_is_broken(F.col("_row"))).select(*keep, *[F.col(f"_row.{f.name}") for f in element.fields])


def opened_pages(pages: DataFrame, element: T.StructType) -> DataFrame:
    """One row per element of each page, and one for a page without any: the
    ``chainid`` and address asked for (``contract_address``), ``chain``, the
    element's fields in ``_row``, and ``_page``: what the page answers, which
    fetch it is, its ``n`` rows if it can be used, and whether the element is
    ``sound`` (NULL without one).

    Rows and state of a page both come from here, so that its JSON is read
    once. ``fetch`` tells pages apart only in what is written down.
    """
    texts = pages.withColumns({"_fetch": F.monotonically_increasing_id(), "_texts": once(_element_texts())})
    good = _error_kind(texts, F.col("_texts")).isNull()
    n = F.when(good, F.size("_texts")).cast("bigint")
    single = texts.select("_fetch", *RANGE, "page", n.alias("n"), F.posexplode_outer(F.when(good, F.col("_texts"))).alias("_place", "_text"))
    rows = single.withColumn("_row", once(_parsed(F.col("_text"), element)))
    sound = F.when(F.col("_place").isNotNull(), ~_is_broken(F.col("_row")))
    return rows.select(
        _chain_id(F.col("chain")).alias("chainid"),
        "chain",
        lower_address(F.col("address")).alias("contract_address"),
        F.struct(F.col("_fetch").alias("fetch"), *RANGE, "page", "n", sound.alias("sound")).alias("_page"),
        F.struct(*[F.col(f"_row.{f.name}") for f in element.fields]).alias("_row"),
    )


def typed_elements(opened: DataFrame, kind: str) -> DataFrame:
    """Opened pages as typed rows in table names, with ``_page``."""
    if kind == "logs":
        named = opened.select("chainid", "chain", "contract_address", "_page", "_row.*")
        return warehouse_logs(_typed(named), ("_page",))
    named = opened.select("chainid", "chain", F.col("contract_address").alias("address"), "_page", "_row.*")
    return warehouse_transactions(_typed(named))


def opened_state(opened: DataFrame) -> DataFrame:
    """As :func:`page_state`, from opened pages that were written down."""
    fetches = opened.select("_page.*").groupBy("fetch", *RANGE, "page")
    found = fetches.agg(F.max("n").alias("n"), F.bool_and("sound").alias("_sound"))
    return merged_state(found.select(*RANGE, "page", F.when(F.coalesce("_sound", F.lit(True)), F.col("n")).alias("n")))


def malformed_elements(pages: DataFrame, element: T.StructType) -> DataFrame:
    """Elements of good pages that do not fit the schema, with the request and their text."""
    asked = [c for c in ("address", "chain", "from_block", "to_block", "page") if c in pages.columns]
    texts = good_pages(pages).select(*asked, F.posexplode(_element_texts()).alias("element", "text"))
    return texts.where(_is_broken(_parsed(F.col("text"), element)))


def _typed(raw: DataFrame) -> DataFrame:
    """Numeric fields of the API as numbers, others untouched."""
    present = [n for n in NUMERIC_FIELDS if n in raw.columns]
    return raw.withColumns(
        {n: (parse_wide_number if n in WIDE_FIELDS else parse_number)(F.col(n)) for n in present}
    )


def logs_from_pages(pages: DataFrame) -> DataFrame:
    """Typed logs in landing names, with the contract and chain they were asked for."""
    asked = pages.withColumns(
        {"contract_address": lower_address(F.col("address")), "chainid": _chain_id(F.col("chain"))}
    ).drop("address")
    raw = _elements(asked, RAW_LOG, ["chainid", "chain", "contract_address"])
    return _typed(raw)


def transactions_from_pages(pages: DataFrame) -> DataFrame:
    """Typed transactions; ``address`` is the contract they were asked for."""
    asked = pages.withColumns(
        {"address": lower_address(F.col("address")), "chainid": _chain_id(F.col("chain"))}
    )
    raw = _elements(asked, RAW_TRANSACTION, ["chainid", "chain", "address"])
    return _typed(raw)


def to_table_names(landed: DataFrame) -> DataFrame:
    """camelCase to the table's snake_case names."""
    return landed.withColumnsRenamed({k: v for k, v in SNAKE_CASE.items() if k in landed.columns})


def warehouse_logs(landed: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Logs as loaded: table names, ``topics`` as JSON text, address lowercased; ``also`` columns stay."""
    named = to_table_names(landed)
    return named.withColumns(
        {"topics": F.to_json("topics"), "address": lower_address(F.col("address"))}
    ).select(*LOG_COLUMNS, *also)


def warehouse_transactions(landed: DataFrame) -> DataFrame:
    named = to_table_names(landed)
    return named.withColumns(
        {
            "from_address": lower_address(F.col("from_address")),
            "to_address": lower_address(F.col("to_address")),
            "hash": with_0x(F.col("hash")),
        }
    )


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """Transaction receipts, one JSON document per file, hash from the content."""
    files = spark.read.text(path, wholetext=True)
    return receipts_from_text(files.select("value"))


def receipts_from_text(texts: DataFrame) -> DataFrame:
    parsed = texts.select(once(F.from_json("value", RECEIPT)).alias("_r")).select("_r.*")
    return parsed.where("transactionHash is not null").withColumn(
        "transactionHash", with_0x(F.col("transactionHash"))
    )


def logs_from_receipts(found: DataFrame) -> DataFrame:
    """The logs nested in receipts, typed, in table names."""
    rows = found.select(F.explode("logs").alias("_log")).select("_log.*")
    return to_table_names(_typed(rows))


def creations_from_pages(pages: DataFrame) -> DataFrame:
    """Creation block per contract; one request may carry many addresses."""
    asked = pages.withColumn("chainid", _chain_id(F.col("chain")))
    raw = _elements(asked, CREATION, ["chainid"])
    return raw.select(
        "chainid",
        lower_address(F.col("contractAddress")).alias("address"),
        F.col("contractCreator").alias("creator"),
        F.col("txHash").alias("transaction_hash"),
        parse_number(F.col("blockNumber")).alias("creation_block"),
    )


def metadata_from_pages(pages: DataFrame) -> DataFrame:
    """Name, proxy flag and implementation: the first element of each good page."""
    first = F.get(F.from_json("result", T.ArrayType(SOURCE_CODE)), F.lit(0))
    found = good_pages(pages).select(lower_address(F.col("address")).alias("address"), once(first).alias("_m"))
    return found.where("_m is not null").select(
        "address",
        F.col("_m.ContractName").alias("contract_name"),
        F.coalesce(F.col("_m.Proxy") == "1", F.lit(False)).alias("proxy"),
        lower_address(F.col("_m.Implementation")).alias("implementation"),
    )


def metadata_rejects(pages: DataFrame) -> DataFrame:
    """Contracts without source code: an empty list or an empty first element."""
    first = F.get(F.from_json("result", "array<string>"), F.lit(0))
    empty = good_pages(pages).where(first.isNull() | first.isin("{}", "", "null"))
    return empty.select(lower_address(F.col("address")).alias("address"))


def page_completeness(pages: DataFrame, page_rows: int = PAGE_ROWS, element: T.StructType | None = None) -> DataFrame:
    """Per requested range: pages seen, rows, and whether all of it is there.

    Paging has no total, so a full last page means more rows may exist. A gap
    in the page numbers shows as ``pages < last_page``. A page that was
    refused counts as good once any fetch of it is; with ``element``, one with
    a malformed element is not good. A range without any good page is not
    complete and has no last page.
    """
    return _by_range(pages, page_rows, element).where("pages > 0")


def incomplete_ranges(pages: DataFrame, page_rows: int = PAGE_ROWS, element: T.StructType | None = None) -> DataFrame:
    """address, chain, from_block, to_block of ranges that have to be fetched again."""
    found = _by_range(pages, page_rows, element).where(~F.coalesce("complete", F.lit(False)))
    return found.select("address", "chain", "from_block", "to_block")


def page_state(pages: DataFrame, element: T.StructType | None = None) -> DataFrame:
    """One row per requested range and page: ``n`` rows if any fetch of it is
    good, else NULL. States of other files merge into it by the greater ``n``.
    """
    good = _error_kind(pages).isNull()
    if element is not None:
        rows = F.transform(_element_texts(), lambda text: _parsed(text, element))
        good = good & ~F.coalesce(F.exists(rows, _is_broken), F.lit(False))
    rows = F.coalesce(F.json_array_length("result"), F.lit(0)).cast("bigint")
    return merged_state(pages.select(*RANGE, "page", F.when(good, rows).alias("n")))


def merged_state(state: DataFrame) -> DataFrame:
    """A page fetched twice counts once, and is good if one fetch of it is."""
    return state.groupBy(*RANGE, "page").agg(F.max("n").alias("n"))


def range_state(state: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Per requested range what its pages' states say: last_page, pages,
    row_count, last_page_rows, complete."""
    is_good = F.col("n").isNotNull()
    grouped = state.groupBy(*RANGE).agg(
        F.max(F.when(is_good, F.col("page"))).alias("last_page"),
        F.count(F.when(is_good, F.col("page"))).alias("pages"),
        F.sum("n").alias("row_count"),
        F.max_by("n", F.when(is_good, F.col("page"))).alias("last_page_rows"),
        F.count_if(~is_good).alias("_refused"),
    )
    complete = (F.col("last_page_rows") < page_rows) & (F.col("pages") == F.col("last_page")) & (F.col("_refused") == 0)
    return grouped.withColumn("complete", complete).drop("_refused")


def _by_range(pages: DataFrame, page_rows: int, element: T.StructType | None) -> DataFrame:
    return range_state(page_state(pages, element), page_rows)
