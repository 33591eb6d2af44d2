"""Every operator as a query over the given tables, next to its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import functions as fn
from blockloom.constants import APPROVAL_TOPIC, CHAIN_IDS, TRANSFER_TOPIC
from blockloom.operators import block_time, dedup, lookups, planning, quality, writing
from blockloom.plans import backfill, catalog, metrics, models
from blockloom.schemas import LOG_COLUMNS, RAW_LOG
from blockloom.session import fresh_path, stage
from blockloom.sources import landing, reference_data, tables
from blockloom.streaming import ingest

from . import fixtures
from .fixtures import duckdb_text, fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *needs: str):
    """Register a query; ``sql`` sees the fixtures in ``needs`` as tables."""

    def wrap(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ctes = [f"{name} as ({duckdb_text(name)})" for name in needs]
            ORACLES[function.__name__] = (f"with {', '.join(ctes)}\n" if ctes else "") + sql
        return function

    return wrap


# Shared pieces of oracle SQL.

def _topic(n: int) -> str:
    return f"json_extract_string(topics, '$[{n}]')"


_DECODED = f"""select chainid, address, {_topic(0)} as topic0, {_topic(1)} as topic1, {_topic(2)} as topic2,
  {_topic(3)} as topic3, data, block_number, make_timestamp(time_stamp * 1000000) as datetime,
  transaction_hash, log_index
from logs where {_topic(0)} is not null"""

_BARE = "lower(replace(data, '0x', ''))"
_DOUBLE = f"""case when {_BARE} <> '' then list_reduce(list_transform(range(1, length({_BARE}) + 1),
  lambda i: instr('123456789abcdef', substr({_BARE}, length({_BARE}) - i + 1, 1))::double * pow(16::double, (i - 1)::double)),
  lambda a, b: a + b, 0::double) end"""


def _u64(start: int) -> str:
    return f"('0x' || substr(lpad({_BARE}, 64, '0'), {start}, 16))::ubigint::uhugeint"


# Exact for words below 2^192: two 128-bit halves, split at 10^18.
_HI, _LO = f"({_u64(17)})", f"({_u64(33)} * 18446744073709551616::uhugeint + {_u64(49)})"
_UNIT = "1000000000000000000::uhugeint"
_D0 = f"({_HI} * 374607431768211456::uhugeint + {_LO} % {_UNIT})"
_TOP = f"({_HI} * 340282366920938463463::uhugeint + {_LO} // {_UNIT} + {_D0} // {_UNIT})"
_EXACT = f"""case when {_TOP} > 0 then {_TOP}::varchar || lpad(({_D0} % {_UNIT})::varchar, 18, '0')
  else {_D0}::varchar end"""

_CHAINS = "(values " + ", ".join(f"('{n}', {i}::bigint)" for n, i in CHAIN_IDS.items()) + ") as chains(chain, chainid)"

_TRANSFER_SELECT = f"""chainid, address as token_address, '0x' || substr({_topic(1)}, 27) as from_address,
  '0x' || substr({_topic(2)}, 27) as to_address"""


# Chain models.

@query(_DECODED, "logs")
def decoded_logs(spark, sf_dir):
    return models.decoded_logs(fixture(spark, sf_dir, "logs"))


@query(
    f"""select {_TRANSFER_SELECT}, {_DOUBLE} as amount, data as amount_hex, block_number,
  make_timestamp(time_stamp * 1000000) as datetime, transaction_hash, log_index
from logs where {_topic(0)} = '{TRANSFER_TOPIC}'""",
    "logs",
)
def erc20_transfer(spark, sf_dir):
    return models.erc20_transfer(fixture(spark, sf_dir, "logs"))


@query(
    f"""select {_TRANSFER_SELECT}, {_EXACT} as amount_text,
  try_cast({_EXACT} as decimal(38,0)) as amount_decimal,
  try_cast({_EXACT} as decimal(38,0)) is null as amount_overflow, transaction_hash, log_index
from logs where {_topic(0)} = '{TRANSFER_TOPIC}'""",
    "logs",
)
def erc20_transfer_exact(spark, sf_dir):
    found = models.with_exact_amount(models.erc20_transfer(fixture(spark, sf_dir, "logs")))
    return found.select(
        "chainid",
        "token_address",
        "from_address",
        "to_address",
        "amount_text",
        "amount_decimal",
        "amount_overflow",
        "transaction_hash",
        "log_index",
    )


@query(
    f"""select {_TRANSFER_SELECT}, {_DOUBLE} as amount, transaction_hash, log_index
from logs where {_topic(0)} = '{TRANSFER_TOPIC}' and {_topic(2)} is not null and {_topic(3)} is null""",
    "logs",
)
def erc20_transfer_strict(spark, sf_dir):
    found = models.erc20_transfer(fixture(spark, sf_dir, "logs"), strict=True)
    return found.select(
        "chainid", "token_address", "from_address", "to_address", "amount", "transaction_hash", "log_index"
    )


@query(
    f"select chainid, address, transaction_hash, log_index from logs where {_topic(0)} = '{APPROVAL_TOPIC}'",
    "logs",
)
def topic_filter(spark, sf_dir):
    found = models.logs_with_topic(fixture(spark, sf_dir, "logs"), APPROVAL_TOPIC)
    return found.select("chainid", "address", "transaction_hash", "log_index")


@query(
    """select chainid, address, block_number, transaction_hash, log_index from logs
where address = '0x0000000000000000000000000000000000001002' and block_number between 18000050 and 18001999""",
    "logs",
)
def contract_block_range(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    found = tables.read_range(logs, 18_000_050, 18_001_999, "0x0000000000000000000000000000000000001002")
    return found.select("chainid", "address", "block_number", "transaction_hash", "log_index")


# Scalar functions.

@query(
    """select event_id, case when trim(raw) in ('', '0x') then null else try_cast(trim(raw) as bigint) end as number
from raw_numbers""",
    "raw_numbers",
)
def parse_num(spark, sf_dir):
    raw = fixture(spark, sf_dir, "raw_numbers")
    return raw.select("event_id", fn.parse_number(F.col("raw")).alias("number"))


@query(
    """select event_id, case when trim(raw) in ('', '0x') then null
  else try_cast(try_cast(trim(raw) as bigint) as decimal(38,0)) end as number
from raw_numbers""",
    "raw_numbers",
)
def parse_wide_num(spark, sf_dir):
    raw = fixture(spark, sf_dir, "raw_numbers")
    return raw.select("event_id", fn.parse_wide_number(F.col("raw")).alias("number"))


@query(
    f"""select transaction_hash, log_index, '0x' || substr({_topic(1)}, 27) as party,
  '0x' || substr(transaction_hash, 27) as tail from logs""",
    "logs",
)
def uint256_address(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    topic = fn.topic_at(fn.json_array(F.col("topics")), 1)
    return logs.select(
        "transaction_hash",
        "log_index",
        fn.uint256_to_address(topic).alias("party"),
        fn.uint256_to_address(F.col("transaction_hash")).alias("tail"),
    )


@query(f"select transaction_hash, log_index, {_DOUBLE} as amount from logs", "logs")
def uint256_double(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    return logs.select("transaction_hash", "log_index", fn.uint256_to_double(F.col("data")).alias("amount"))


@query(
    f"""select transaction_hash, log_index, {_EXACT} as amount_text,
  try_cast({_EXACT} as decimal(38,0)) as amount from logs""",
    "logs",
)
def uint256_exact(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    text = logs.select("transaction_hash", "log_index", fn.hex_to_numeric(F.col("data")).alias("amount_text"))
    return text.withColumn("amount", F.col("amount_text").try_cast("decimal(38,0)"))


@query(
    """select transaction_hash, log_index, case when data like '0x%' then substr(data, 3) else data end as hex_data,
  ('0x' || substr(transaction_hash, 51))::bigint as tx_number from logs""",
    "logs",
)
def hex_helpers(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    return logs.select(
        "transaction_hash",
        "log_index",
        fn.extract_hex_data(F.col("data")).alias("hex_data"),
        fn.hex_to_bigint(F.col("transaction_hash")).alias("tx_number"),
    )


@query(
    f"""select transaction_hash, log_index,
  lower('0x' || substr({_topic(2)}, 27)) = '0x0000000000000000000000000000000000000000' as burned from logs""",
    "logs",
)
def is_zero_address(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs")
    receiver = fn.uint256_to_address(fn.topic_at(fn.json_array(F.col("topics")), 2))
    return logs.select("transaction_hash", "log_index", fn.is_zero_address(receiver).alias("burned"))


@query("select hash, make_timestamp(time_stamp * 1000000) as datetime from transactions", "transactions")
def epoch_datetime(spark, sf_dir):
    tx = fixture(spark, sf_dir, "transactions")
    return tx.select("hash", fn.epoch_datetime(F.col("time_stamp")).alias("datetime"))


@query(
    f"""select transaction_hash, log_index, json_array_length(topics)::bigint as topic_count,
  {_topic(0)} as topic0, {_topic(3)} as topic3 from logs""",
    "logs",
)
def json_topics(spark, sf_dir):
    logs = fixture(spark, sf_dir, "logs").withColumn("_t", fn.json_array(F.col("topics")))
    return logs.select(
        "transaction_hash",
        "log_index",
        F.json_array_length("topics").cast("bigint").alias("topic_count"),
        fn.topic_at(F.col("_t"), 0).alias("topic0"),
        fn.topic_at(F.col("_t"), 3).alias("topic3"),
    )


@query(
    f"""select transaction_hash, log_index, '0x' || substr({_topic(1)}, 27) as party, {_DOUBLE} as amount,
  {_EXACT} as amount_text, ('0x' || substr(transaction_hash, 51))::bigint as tx_number from logs""",
    "logs",
)
def sql_functions(spark, sf_dir):
    fn.register(spark)
    return spark.sql(
        f"""select transaction_hash, log_index,
        uint256_to_address(get(from_json(topics, 'array<string>'), 1)) as party,
        uint256_to_numeric(data) as amount, hex_to_numeric(data) as amount_text,
        hex_to_bigint(transaction_hash) as tx_number
        from ({fixtures.spark_text(spark, sf_dir, "logs")})"""
    )


# Landed pages.

_GOOD_PAGE = "(((block_number - 18000000) * 4 + log_index) // 1000) % 10 not in (3, 7)"


@query(
    f"""select case when true then 1::bigint end as chainid, 'ethereum' as chain,
  '0x0000000000000000000000000000000000001000' as contract_address, address, to_json(topics) as topics, data,
  block_number, block_hash, time_stamp, gas_price, gas_used, log_index, transaction_hash, transaction_index
from logs where {_GOOD_PAGE}""".replace("to_json(topics)", "topics"),
    "logs",
)
def log_pages_typed(spark, sf_dir):
    rows = landing.to_table_names(landing.logs_from_pages(fixtures.log_pages(spark, sf_dir)))
    return rows.withColumn("topics", F.to_json("topics"))


@query(
    f"""select 1::bigint as chainid, address, topics, data, block_number, block_hash, time_stamp, gas_price,
  gas_used, log_index, transaction_hash, transaction_index from logs where {_GOOD_PAGE}""",
    "logs",
)
def loaded_logs(spark, sf_dir):
    return landing.warehouse_logs(landing.logs_from_pages(fixtures.log_pages(spark, sf_dir)))


@query(
    """select 1::bigint as chainid, 'ethereum' as chain, '0x0000000000000000000000000000000000001000' as address,
  hash, block_number, transaction_index, from_address, to_address, value, gas_price, gas_used,
  null::bigint as confirmations, input, time_stamp
from transactions""",
    "transactions",
)
def transactions_typed(spark, sf_dir):
    rows = landing.warehouse_transactions(
        landing.transactions_from_pages(fixtures.transaction_pages(spark, sf_dir))
    )
    return rows.select(
        "chainid",
        "chain",
        "address",
        "hash",
        "block_number",
        "transaction_index",
        "from_address",
        "to_address",
        "value",
        "gas_price",
        "gas_used",
        "confirmations",
        "input",
        "time_stamp",
    )


@query(
    """select page, case page % 10 when 8 then 'rate_limit' else 'api_error' end as error_kind,
  case page % 10 when 8 then 'Max Rate Limit reached' else 'NOTOK' end as message
from (select distinct event_id // 1000 + 1 as page from events) where page % 10 in (4, 8)"""
)
def rejects(spark, sf_dir):
    return landing.rejected_pages(fixtures.log_pages(spark, sf_dir)).select("page", "error_kind", "message")


@query(
    """with pages as (select event_id // 1000 + 1 as page, count(*) as n from events group by 1),
good as (select * from pages where page % 10 not in (4, 8))
select '0x0000000000000000000000000000000000001000' as address, 'ethereum' as chain,
  18000000::bigint as from_block, 19000000::bigint as to_block, max(page) as last_page, count(*) as pages,
  sum(n)::bigint as row_count, arg_max(n, page) as last_page_rows,
  arg_max(n, page) < 1000 and count(*) = max(page) and not exists (select 1 from pages where page % 10 in (4, 8)) as complete
from good"""
)
def page_completeness(spark, sf_dir):
    return landing.page_completeness(fixtures.log_pages(spark, sf_dir))


@query(
    """with pages as (select event_id // 1000 + 1 as page, count(*) as n from events group by 1),
good as (select * from pages where page % 10 not in (4, 8))
select distinct 'logs' as "table", '0x0000000000000000000000000000000000001000' as contract_address,
  1::bigint as chainid, 18000000::bigint as from_block, 19000000::bigint as to_block,
  20000::bigint as block_chunk_size
from events where exists (select 1 from pages where page % 10 in (4, 8))
  or (select arg_max(n, page) = 1000 or count(*) < max(page) from good)"""
)
def failed_page_ranges(spark, sf_dir):
    return backfill.failed_ranges(fixtures.log_pages(spark, sf_dir), "logs")


@query(
    "select address, topics, data, block_number, transaction_hash, log_index from logs",
    "logs",
)
def receipt_logs(spark, sf_dir):
    found = landing.logs_from_receipts(landing.receipts_from_text(fixtures.receipt_texts(spark, sf_dir)))
    return found.select(
        "address", F.to_json("topics").alias("topics"), "data", "block_number", "transaction_hash", "log_index"
    )


@query(
    """select chainid, address, '0xc' as creator, ('0x' || substr(address, 27))::bigint + 17900000 as creation_block
from contracts""",
    "contracts",
)
def creation_info(spark, sf_dir):
    found = landing.creations_from_pages(fixtures.creation_pages(spark, sf_dir))
    return found.select("chainid", "address", "creator", "creation_block")


@query(
    """select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address, 'C' || s_suppkey::varchar as contract_name,
  s_suppkey % 2 = 1 as proxy, '0xi' as implementation from supplier where s_suppkey % 7 <> 0"""
)
def contract_metadata(spark, sf_dir):
    return landing.metadata_from_pages(fixtures.metadata_pages(spark, sf_dir))


@query(
    "select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address from supplier where s_suppkey % 7 = 0"
)
def missing_metadata(spark, sf_dir):
    return landing.metadata_rejects(fixtures.metadata_pages(spark, sf_dir))


# Chains.

@query(f"select event_id, chain, chainid from named_chains join {_CHAINS} using (chain)", "named_chains")
def chain_lookup(spark, sf_dir):
    return lookups.with_chain_id(fixture(spark, sf_dir, "named_chains")).select("event_id", "chain", "chainid")


@query(f"select event_id, chain from named_chains where chain not in (select chain from {_CHAINS})", "named_chains")
def unknown_chains(spark, sf_dir):
    return lookups.unknown_chains(fixture(spark, sf_dir, "named_chains")).select("event_id", "chain")


@query(
    f"""select event_id, event_id % 60 as chainid, coalesce(chain, 'unknown') as chain
from events left join {_CHAINS} on event_id % 60 = chainid"""
)
def chain_reverse(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ids = events.select("event_id", (F.col("event_id") % 60).alias("chainid"))
    return lookups.with_chain_name(ids).select("event_id", "chainid", "chain")


@query(
    f"select distinct chain from named_chains join {_CHAINS} using (chain) order by chain", "named_chains"
)
def active_chains(spark, sf_dir):
    known = lookups.with_chain_id(fixture(spark, sf_dir, "named_chains"))
    return known.select("chain").distinct().orderBy("chain")


# Appending.

@query(
    "select * from first_fetch union select * from second_fetch", "first_fetch", "second_fetch"
)
def append_distinct(spark, sf_dir):
    return dedup.union_distinct(fixture(spark, sf_dir, "first_fetch"), fixture(spark, sf_dir, "second_fetch"))


@query(
    "select * from second_fetch except select * from first_fetch", "first_fetch", "second_fetch"
)
def new_rows(spark, sf_dir):
    return dedup.new_rows(fixture(spark, sf_dir, "second_fetch"), fixture(spark, sf_dir, "first_fetch"))


@query(
    """select (select count(*) from first_fetch) as existing,
  (select count(*) from (select * from second_fetch except select * from first_fetch)) as added,
  (select count(*) from (select * from second_fetch union select * from first_fetch)) as combined""",
    "first_fetch",
    "second_fetch",
)
def rows_added(spark, sf_dir):
    return dedup.rows_added(fixture(spark, sf_dir, "second_fetch"), fixture(spark, sf_dir, "first_fetch"))


@query(
    """select hash, chainid, value, confirmations from (
  select hash, chainid, value, confirmations,
    row_number() over (partition by chainid, hash order by confirmations desc) as n
  from (select hash, chainid, value, 5::bigint as confirmations from transactions
    union all select hash, chainid, value, block_number % 9 as confirmations from transactions)) where n = 1""",
    "transactions",
)
def append_latest_by_key(spark, sf_dir):
    tx = fixture(spark, sf_dir, "transactions").select("hash", "chainid", "value", "block_number")
    first = tx.withColumn("confirmations", F.lit(5).cast("bigint"))
    again = tx.withColumn("confirmations", F.col("block_number") % 9)
    both = first.unionByName(again).drop("block_number")
    return dedup.latest_by_key(both, ["chainid", "hash"], ["confirmations"])


@query(
    "select chainid, transaction_hash, log_index, address, data from logs", "logs"
)
def table_append_twice(spark, sf_dir):
    """Two overlapping appends to a partitioned table leave each log once."""
    logs = fixture(spark, sf_dir, "logs")
    path = fresh_path(spark, "append")
    sort = ["address", "block_number", "log_index"]
    writing.append_new(logs.unionByName(logs), path, sort, ("transaction_hash",))
    writing.append_new(logs, path, sort, ("transaction_hash",))
    return spark.read.parquet(path).select("chainid", "transaction_hash", "log_index", "address", "data")


# Planning.

@query(
    "select chainid, lower(address) as address, max(block_number) as max_block from logs group by all", "logs"
)
def resume_block(spark, sf_dir):
    return planning.resume_blocks(fixture(spark, sf_dir, "logs"))


@query(
    """select c.chainid, c.address, coalesce(max(l.block_number), 0) as max_block
from contracts c left join logs l on c.chainid = l.chainid and c.address = l.address group by all""",
    "contracts",
    "logs",
)
def high_water_mark(spark, sf_dir):
    marks = planning.high_water_marks(fixture(spark, sf_dir, "contracts"), fixture(spark, sf_dir, "logs"))
    return marks.select("chainid", "address", "max_block")


@query(
    "select 'logs' as name, count(*) as row_count from logs union all select 'transactions', count(*) from transactions",
    "logs",
    "transactions",
)
def row_counts(spark, sf_dir):
    counts = [
        fixture(spark, sf_dir, n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("name"), "row_count")
        for n in ("logs", "transactions")
    ]
    return counts[0].unionByName(counts[1])


@query(
    """, marks as (select chainid, address, 'logs' as kind, max(block_number) as m from logs group by 1, 2
  union all select chainid, to_address, 'transactions', max(block_number) from transactions group by 1, 2),
bounds as (select c.chainid, c.address, k.kind,
  coalesce(m.m, c.from_block, ('0x' || substr(c.address, 27))::bigint + 17900000) as from_block,
  (select max(block_number) from block_times) as to_block
  from contracts c cross join (values ('logs'), ('transactions')) k(kind)
  left join marks m on m.chainid = c.chainid and m.address = c.address and m.kind = k.kind)
select chainid, address, kind, from_block, to_block, s as chunk_start, least(s + 19999, to_block) as chunk_end
from bounds, unnest(generate_series(from_block, to_block, 20000)) as g(s)""",
    "contracts",
    "logs",
    "transactions",
    "block_times",
)
def chunk_plan(spark, sf_dir):
    logs = planning.resume_blocks(fixture(spark, sf_dir, "logs")).withColumn("kind", F.lit("logs"))
    tx = planning.resume_blocks(fixture(spark, sf_dir, "transactions"), "to_address").withColumn(
        "kind", F.lit("transactions")
    )
    latest = fixture(spark, sf_dir, "block_times").groupBy("chainid").agg(
        F.max("block_number").alias("latest_block")
    )
    contracts = fixture(spark, sf_dir, "contracts").withColumn("to_block", F.lit(None).cast("bigint"))
    creations = landing.creations_from_pages(fixtures.creation_pages(spark, sf_dir))
    return planning.fetch_plan(contracts, logs.unionByName(tx), latest, creations)


@query(
    """select contract_address, chainid, greatest(block_chunk_size // 10, 1000) as retry_size, s as chunk_start,
  least(s + greatest(block_chunk_size // 10, 1000) - 1, to_block) as chunk_end
from failed_ranges, unnest(generate_series(from_block, to_block, greatest(block_chunk_size // 10, 1000))) as g(s)""",
    "failed_ranges",
)
def retry_plan(spark, sf_dir):
    plan = planning.retry_plan(fixture(spark, sf_dir, "failed_ranges"))
    return plan.select("contract_address", "chainid", "retry_size", "chunk_start", "chunk_end")


@query(
    """select chainid, address, coalesce(from_block, ('0x' || substr(address, 27))::bigint + 17900000) as from_block
from contracts""",
    "contracts",
)
def creation_default(spark, sf_dir):
    creations = landing.creations_from_pages(fixtures.creation_pages(spark, sf_dir))
    return lookups.with_creation_block(fixture(spark, sf_dir, "contracts"), creations).select(
        "chainid", "address", "from_block"
    )


def _asof(block: str, compare: str) -> str:
    return f""", b as (select chainid, time_stamp, {block}(block_number) as block_number from block_times group by 1, 2)
select p.probe_id, p.chainid, p.t, b.block_number from time_probes p
asof left join b on p.chainid = b.chainid and p.t {compare} b.time_stamp"""


@query(_asof("max", ">="), "block_times", "time_probes")
def block_at_time(spark, sf_dir):
    found = block_time.blocks_at(fixture(spark, sf_dir, "time_probes"), fixture(spark, sf_dir, "block_times"))
    return found.select("probe_id", "chainid", "t", "block_number")


@query(_asof("min", "<="), "block_times", "time_probes")
def block_after_time(spark, sf_dir):
    found = block_time.blocks_at(
        fixture(spark, sf_dir, "time_probes"), fixture(spark, sf_dir, "block_times"), "after"
    )
    return found.select("probe_id", "chainid", "t", "block_number")


@query(
    """select hash, block_number, transaction_index from transactions
order by block_number, transaction_index""",
    "transactions",
)
def transactions_sorted(spark, sf_dir):
    tx = fixture(spark, sf_dir, "transactions")
    return planning.in_chain_order(tx).select("hash", "block_number", "transaction_index")


@query(
    """select hash, block_number, transaction_index from transactions
order by block_number desc, transaction_index desc limit 100 offset 200""",
    "transactions",
)
def page_slice(spark, sf_dir):
    order = [F.col("block_number").desc(), F.col("transaction_index").desc()]
    page = planning.page_slice(fixture(spark, sf_dir, "transactions"), order, page=3, rows=100)
    return page.select("hash", "block_number", "transaction_index")


# Data quality.

def _nulls(table: str, **columns: str) -> str:
    rows = " union all ".join(
        f"select '{table}' as \"table\", '{name}' as \"column\", count(*) filter ({expr} is null) as violations, "
        f"count(*) filter ({expr} is null) = 0 as passed from t"
        for name, expr in columns.items()
    )
    return rows


@query(
    ", t as (select * from logs) "
    + _nulls("logs", **{c: c for c in ("chainid", "address", "topics", "block_number", "transaction_hash")}),
    "logs",
)
def not_null_logs(spark, sf_dir):
    return quality.not_null(fixture(spark, sf_dir, "logs"), "logs")


@query(
    f", t as ({_DECODED}) "
    + _nulls("decoded_logs", **{c: c for c in ("chainid", "address", "block_number", "transaction_hash")}),
    "logs",
)
def not_null_decoded(spark, sf_dir):
    return quality.not_null(models.decoded_logs(fixture(spark, sf_dir, "logs")), "decoded_logs")


_PARTIES = f", t as (select *, {_topic(1)} as topic1, {_topic(2)} as topic2 from logs where {_topic(0)} = '{{}}') "


@query(
    _PARTIES.format(TRANSFER_TOPIC)
    + _nulls(
        "erc20_transfer",
        chainid="chainid",
        token_address="address",
        from_address="topic1",
        to_address="topic2",
        block_number="block_number",
        datetime="time_stamp",
        transaction_hash="transaction_hash",
    ),
    "logs",
)
def not_null_transfer(spark, sf_dir):
    return quality.not_null(models.erc20_transfer(fixture(spark, sf_dir, "logs")), "erc20_transfer")


@query(
    _PARTIES.format(APPROVAL_TOPIC)
    + _nulls("approvals", address="address", topic1="topic1", topic2="topic2"),
    "logs",
)
def not_null_approvals(spark, sf_dir):
    """A check that fails: one-topic approvals have no parties."""
    approvals = models.logs_with_topic(fixture(spark, sf_dir, "logs"), APPROVAL_TOPIC)
    return quality.not_null(approvals, "approvals", ("address", "topic1", "topic2"))


# Metric feeds.

def _wrapped(rows: DataFrame, name: str) -> DataFrame:
    """Single items to responses holding a list of them."""
    text = F.concat(F.lit(f'{{"{name}":['), F.col("payload"), F.lit("]}"))
    return rows.withColumn("payload", text)


@query(
    """select event_id, 'peggedUSD' as peg_type, 'm' || (event_id % 3)::varchar as peg_mechanism, 'p' as price_source,
  '["A","B"]' as chains, case when event_id % 5 <> 0 then event_id + 0.5::double end as circulating,
  user_id::double as circulating_prev_day, null::double as circulating_prev_week,
  null::double as circulating_prev_month, '{"name":"c' || event_id::varchar || '"}' as other_fields
from events where event_id % 7 <> 0"""
)
def stablecoins_metadata(spark, sf_dir):
    rows = _wrapped(fixture(spark, sf_dir, "stablecoin_rows"), "peggedAssets")
    return metrics.stablecoins_metadata(rows).withColumn("other_fields", F.to_json("other_fields"))


@query(
    """select event_id, event_id::varchar as defillama_id, event_type as parent_protocol, '["A"]' as chains,
  null::varchar as audit_links, '2' as audits, '{"name":"n"}' as other_fields from events"""
)
def protocol_data(spark, sf_dir):
    rows = metrics.protocol_data(fixture(spark, sf_dir, "protocol_rows"))
    return rows.withColumn("other_fields", F.to_json("other_fields"))


@query(
    """select user_id, event_id, '{"name":"coin"}' as metadata, 'Ethereum' as chain, event_id as circulating,
  date_trunc('second', ts) as timestamp from events
union all
select user_id, event_id, '{"name":"coin"}', 'Base', user_id, timestamp '1970-01-01 00:00:02' from events"""
)
def stablecoin_history(spark, sf_dir):
    rows = metrics.stablecoin_history(fixture(spark, sf_dir, "balance_rows"), include_metadata=True)
    return rows.withColumn("metadata", F.to_json("metadata"))


@query(
    """select user_id, event_id, 'Ethereum' as chain, event_id as circulating,
  timestamp '2024-02-01 00:00:00' as timestamp from events"""
)
def stablecoin_current(spark, sf_dir):
    return metrics.stablecoin_current(fixture(spark, sf_dir, "balance_rows"), as_of=F.lit(1_706_745_600))


_PRICES = """select event_id, 'ethereum' as network, '0x' || lpad(lower(to_hex(user_id)), 40, '0') as contract_address,
  'S' || user_id::varchar as symbol, 18 as decimals, 0.99::double as confidence,
  date_trunc('second', ts) as timestamp, event_id % 1000 + 0.5::double as price from events
union all
select event_id, 'ethereum', '0x' || lpad(lower(to_hex(user_id)), 40, '0'), 'own', 18, 0.99::double,
  date_trunc('second', ts) + interval 1 hour, event_id % 500 + 0.25::double from events"""


@query(_PRICES)
def token_price(spark, sf_dir):
    return metrics.token_price(fixture(spark, sf_dir, "price_rows"))


@query(
    f"""select event_id, network, contract_address, symbol, decimals, confidence, timestamp,
  price::decimal(38,9) as price from ({_PRICES})"""
)
def price_typed(spark, sf_dir):
    return metrics.typed_price(metrics.token_price(fixture(spark, sf_dir, "price_rows")))


@query(
    f"""select network, contract_address, date_trunc('day', timestamp) as timestamp,
  arg_min(price, (timestamp, price))::decimal(38,9) as open, max(price)::decimal(38,9) as high,
  min(price)::decimal(38,9) as low, arg_max(price, (timestamp, price))::decimal(38,9) as close
from ({_PRICES}) group by 1, 2, 3"""
)
def price_ohlc(spark, sf_dir):
    prices = metrics.typed_price(metrics.token_price(fixture(spark, sf_dir, "price_rows")))
    return metrics.price_ohlc(prices, ["network", "contract_address"])


@query(
    """select event_id, 'p' || event_id::varchar as pool, 'Ethereum' as chain, event_type as project, 'X' as symbol,
  user_id + 0.5::double as tvl_usd, 1.25::double as apy, null::double as apy_base, null::double as apy_reward,
  case when event_id % 3 = 1 then '["0xa","0xb"]' else '[]' end as reward_tokens,
  '["0xc"]' as underlying_tokens, '{}' as other_fields from events"""
)
def yield_pools(spark, sf_dir):
    rows = metrics.yield_pools(fixture(spark, sf_dir, "pool_rows"))
    return rows.withColumn("other_fields", F.to_json("other_fields"))


@query(
    """select 'p' || user_id::varchar as pool_id, 'Pool ' || user_id::varchar as pool_name, event_id,
  make_timestamp(2024, 1, event_id % 28 + 1, 23, 1, 2) as timestamp, event_id::double as tvl_usd,
  null::double as apy, 2.5::double as apy_base, null::double as apy_reward from events"""
)
def yield_chart(spark, sf_dir):
    return metrics.yield_chart(fixture(spark, sf_dir, "pool_chart_rows")).drop("other_fields")


@query(
    """select event_id, event_type as protocol, date_trunc('second', ts) as timestamp,
  event_id + 0.25::double as revenue from events"""
)
def revenue_total(spark, sf_dir):
    return metrics.revenue_total(fixture(spark, sf_dir, "revenue_rows"))


@query(
    """select event_id, event_type as protocol, date_trunc('second', ts) as timestamp, 'ethereum' as chain,
  sub_protocol, case sub_protocol when 'v1' then event_id + 0.5::double else 1::double end as revenue
from events cross join (values ('v1'), ('v2')) as s(sub_protocol)"""
)
def revenue_breakdown(spark, sf_dir):
    return metrics.revenue_breakdown(fixture(spark, sf_dir, "revenue_rows"))


# Contracts and events.

@query(
    "select address, implementation_address from proxies", "proxies"
)
def proxy_pairs(spark, sf_dir):
    pairs = fixture(spark, sf_dir, "proxies")
    return reference_data.merge_proxy_pairs(pairs, pairs)


@query(
    """select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address,
  case when s_suppkey % 2 = 1 then '0x' || lpad(lower(to_hex(s_suppkey + 1)), 40, '0') end as implementation_address
from supplier"""
)
def proxy_lookup(spark, sf_dir):
    contracts = fixture(spark, sf_dir, "abis").select("address")
    return lookups.with_implementation(contracts, fixture(spark, sf_dir, "proxies"))


_SYNC = "0x1c411e9a96e071241c2f21f7726b17ae89e3cab4c78be50e062b03a9fffbbad1"
_OWN_EVENTS = f"""own as (select s_suppkey, 'Transfer' as event_name, '{TRANSFER_TOPIC}' as topic0,
  'Transfer(address,address,uint256)' as event_signature from supplier
union all select s_suppkey, 'Sync', '{_SYNC}', 'Sync(uint112,uint112)' from supplier where s_suppkey % 3 = 0)"""


@query(
    f"""with {_OWN_EVENTS}, combined as (select * from own
  union all select p.s_suppkey, o.event_name, o.topic0, o.event_signature
  from supplier p join own o on o.s_suppkey = p.s_suppkey + 1 where p.s_suppkey % 2 = 1)
select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address, event_name, topic0, event_signature,
  false as anonymous from combined"""
)
def event_catalog(spark, sf_dir):
    entries = reference_data.abi_entries(fixture(spark, sf_dir, "abis"))
    combined = catalog.combined_abi(entries, fixture(spark, sf_dir, "proxies"))
    return catalog.event_catalog(combined).drop("params")


def _log_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.event_catalog(reference_data.abi_entries(fixture(spark, sf_dir, "log_abis")))


_EVENT_NAME = f"case topic0 when '{TRANSFER_TOPIC}' then 'Transfer' else 'Approval' end"


@query(
    f""", decoded as ({_DECODED})
select chainid, address, topic0, transaction_hash, log_index, {_EVENT_NAME} as event_name,
  {_EVENT_NAME} || '(address,address,uint256)' as event_signature from decoded""",
    "logs",
)
def event_labels(spark, sf_dir):
    decoded = models.decoded_logs(fixture(spark, sf_dir, "logs"))
    return catalog.label_events(decoded, _log_catalog(spark, sf_dir)).select(
        "chainid", "address", "topic0", "transaction_hash", "log_index", "event_name", "event_signature"
    )


def _json_address(topic: str) -> str:
    return f"""coalesce('"0x' || substr({topic}, 27) || '"', 'null')"""


@query(
    f""", decoded as ({_DECODED}), named as (select *, {_EVENT_NAME} as event_name,
  case when data = '0x' then 'null' else '"' || ({_EXACT}) || '"' end as amount from decoded)
select chainid, address, transaction_hash, log_index, event_name,
  case when topic2 is null or topic3 is not null then null else case event_name when 'Transfer' then '{{"from":' || {_json_address("topic1")} || ',"to":' || {_json_address("topic2")}
  else '{{"owner":' || {_json_address("topic1")} || ',"spender":' || {_json_address("topic2")} end
  || ',"value":' || amount || '}}' end as decoded_data from named""",
    "logs",
)
def decoded_params(spark, sf_dir):
    decoded = models.decoded_logs(fixture(spark, sf_dir, "logs"))
    return catalog.described_logs(decoded, _log_catalog(spark, sf_dir)).select(
        "chainid", "address", "transaction_hash", "log_index", "event_name", "decoded_data"
    )


@query(
    f"""select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address, 'Deep' || s_suppkey::varchar as event_name,
  'Deep' || s_suppkey::varchar || '({"(" * 6}uint256{")" * 6})' as event_signature, true as has_topic from supplier"""
)
def deep_signatures(spark, sf_dir):
    """Tuples nested six levels deep in every supplier's ABI."""
    inner = '{"name":"x","type":"uint256"}'
    for _ in range(6):
        inner = '{"name":"t","type":"tuple","components":[' + inner + "]}"
    key = F.col("s_suppkey")
    texts = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(key)), 40, "0")).alias("address"),
        F.concat(F.lit('[{"type":"event","name":"Deep'), key.cast("string"), F.lit('","inputs":[' + inner + "]}]")).alias("value"),
    )
    found = catalog.event_catalog(reference_data.abi_entries(texts))
    return found.select("address", "event_name", "event_signature", F.col("topic0").isNotNull().alias("has_topic"))


_TWO_TRANSFERS = [
    ("0xa", '[{"type":"event","name":"Transfer","inputs":[{"name":"from","type":"address","indexed":true},'
     '{"name":"to","type":"address","indexed":true},{"name":"value","type":"uint256","indexed":false}]}]'),
    ("0xb", '[{"type":"event","name":"Transfer","inputs":[{"name":"from","type":"address","indexed":true},'
     '{"name":"to","type":"address","indexed":true},{"name":"tokenId","type":"uint256","indexed":true}]}]'),
]


@query(
    f""", decoded as ({_DECODED}), transfers as (
  select *, coalesce(({_EXACT})::varchar, 'null') as amount from decoded where topic0 = '{TRANSFER_TOPIC}')
select transaction_hash, log_index, 'Transfer' as event_name,
  '{{"from":' || {_json_address("topic1")} || ',"to":' || {_json_address("topic2")} || case when topic3 is null
    then ',"value":"' || amount || '"}}' else ',"tokenId":"' || ('0x' || substr(topic3, 51))::bigint::varchar || '"}}' end as decoded_data
from transfers""",
    "logs",
)
def transfer_layouts(spark, sf_dir):
    """Token and NFT transfers share a topic; contracts without ABI get the layout that fits."""
    decoded = models.decoded_logs(fixture(spark, sf_dir, "logs")).where(F.col("topic0") == TRANSFER_TOPIC)
    entries = reference_data.abi_entries(spark.createDataFrame(_TWO_TRANSFERS, "address string, value string"))
    found = catalog.described_logs(decoded, catalog.event_catalog(entries))
    return found.select("transaction_hash", "log_index", "event_name", "decoded_data")


@query(
    """select event_id, case when event_id % 7 = 0 then '{"ids":null}'
  else '{"ids":"[\\"' || event_id::varchar || '\\",\\"' || user_id::varchar || '\\"]"}' end as decoded_data from events"""
)
def decoded_arrays(spark, sf_dir):
    """Lists of two numbers; every seventh states more items than there are."""
    abi = '[{"type":"event","name":"Batch","inputs":[{"name":"ids","type":"uint256[]","indexed":false}]}]'
    known = catalog.event_catalog(reference_data.abi_entries(spark.createDataFrame([("0xa", abi)], "address string, value string")))
    number = lambda x: F.lpad(F.lower(F.hex(x)), 64, "0")
    items = F.when(F.col("event_id") % 7 == 0, F.lit(9)).otherwise(F.lit(2))
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.lit("0xa").alias("address"), F.lit(known.first()["topic0"]).alias("topic0"),
        *[F.lit(None).cast("string").alias(f"topic{n}") for n in (1, 2, 3)],
        F.concat(F.lit("0x"), number(F.lit(32)), number(items), number("event_id"), number("user_id")).alias("data"),
    )
    return catalog.described_logs(logs, known).select("event_id", "decoded_data")


# Faults of landed pages.

_ODD = """pages as (select event_id // 1000 + 1 as p, count(*) as n, (event_id // 1000 + 1) % 7 as kind
  from events group by event_id // 1000)"""
_ODD_ASKED = """'0x0000000000000000000000000000000000001000' as address, 'ethereum' as chain,
  p * 1000 as from_block, p * 1000 + 999 as to_block"""


@query(
    f"""with {_ODD} select {_ODD_ASKED}, 1::bigint as last_page, 1::bigint as pages,
  (case when kind = 4 then 0 else n end)::bigint as row_count, (case when kind = 4 then 0 else n end)::bigint as last_page_rows,
  true as complete from pages where kind not in (2, 3, 5)"""
)
def odd_page_completeness(spark, sf_dir):
    return landing.page_completeness(fixtures.odd_log_pages(spark, sf_dir), 1001, RAW_LOG)


@query(
    f"""with {_ODD} select p * 1000 as from_block, case kind when 2 then 'malformed_result' else 'unknown_chain' end as error_kind
from pages where kind in (2, 5)"""
)
def malformed_pages(spark, sf_dir):
    return landing.rejected_pages(fixtures.odd_log_pages(spark, sf_dir)).select("from_block", "error_kind")


@query(f"with {_ODD} select p * 1000 as from_block, 0 as element, '5' as text from pages where kind = 3")
def malformed_elements(spark, sf_dir):
    found = landing.malformed_elements(fixtures.odd_log_pages(spark, sf_dir), RAW_LOG)
    return found.select("from_block", "element", "text")


def _odd_failures(kinds: str) -> str:
    return f"""with {_ODD} select 'logs' as "table", '0x0000000000000000000000000000000000001000' as contract_address,
  case when kind = 5 then null else 1::bigint end as chainid, p * 1000 as from_block, p * 1000 + 999 as to_block,
  1000::bigint as block_chunk_size from pages where kind in {kinds}"""


@query(_odd_failures("(2, 3, 5)"))
def malformed_ranges(spark, sf_dir):
    return backfill.failed_ranges(fixtures.odd_log_pages(spark, sf_dir), "logs", 1001)


@query(_odd_failures("(3, 5)"))
def refetched_page(spark, sf_dir):
    """A page that was cut off and came well in another fetch is not missing, whichever came first."""
    odd = fixtures.odd_log_pages(spark, sf_dir)
    whole = fixtures.log_pages(spark, sf_dir, rejects=False).where("page % 7 = 2").withColumns(
        {"from_block": F.col("page") * 1000, "to_block": F.col("page") * 1000 + 999, "page": F.lit(1).cast("bigint")}
    )
    return backfill.failed_ranges(whole.unionByName(odd), "logs", 1001)


@query(
    f"""select 1::bigint as chainid, address, topics, data, block_number, block_hash, time_stamp, gas_price,
  gas_used, log_index, transaction_hash, transaction_index from logs where {_GOOD_PAGE}""",
    "logs",
)
def load_logs(spark, sf_dir):
    folder, out, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    fixtures.log_pages(spark, sf_dir).write.json(folder)
    backfill.load_landing(spark, folder, out, ledger)
    backfill.load_landing(spark, folder, out, ledger)
    return spark.read.parquet(out).select(*LOG_COLUMNS)


@query("select count(*) as row_count, 0::bigint as open_ranges, (select count(*) from (select 1 from events where event_id // 1000 % 10 in (3, 7) limit 1)) as entries_before from logs", "logs")
def ledger_settles(spark, sf_dir):
    """Refused pages are ledgered; fetched again, and with the empty page that ends them, the range is settled for good."""
    folder, out, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    end = fixtures.empty_page(spark, sf_dir)
    fixtures.log_pages(spark, sf_dir).unionByName(end).write.json(folder)
    first = backfill.load_landing(spark, folder, out, ledger).failed_ranges
    fixtures.log_pages(spark, sf_dir, rejects=False).write.mode("append").json(folder)
    for _ in range(2):
        backfill.load_landing(spark, folder, out, ledger)
    entries = writing.stored_table(spark, ledger, None)
    still = writing.open_failures(entries) if entries is not None else spark.range(0)
    return (
        spark.read.parquet(out).groupBy().agg(F.count("*").alias("row_count"))
        .crossJoin(still.groupBy().agg(F.count("*").alias("open_ranges")))
        .withColumn("entries_before", F.lit(first).cast("bigint"))
    )


@query(
    """select count(*) as row_count, 1::bigint as open_before, 0::bigint as open_after, 18000000::bigint as whole_from,
  19000000::bigint as whole_to, 501::bigint as windows from logs""",
    "logs",
)
def retry_settles(spark, sf_dir):
    """A failed range is fetched again in windows; together they settle it, and nothing is planned any more."""
    folder, out, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    fixtures.log_pages(spark, sf_dir).unionByName(fixtures.broken_page(spark, sf_dir)).write.json(folder)
    backfill.load_landing(spark, folder, out, ledger)
    failed = writing.open_failures(spark.read.parquet(ledger))
    windows = stage(planning.retry_plan(failed).select("chunk_start", "chunk_end"), "windows")
    before, planned = failed.count(), windows.count()
    fixtures.window_pages(spark, sf_dir, windows).write.mode("append").json(folder)
    backfill.load_landing(spark, folder, out, ledger)
    entries = spark.read.parquet(ledger)
    counts = spark.read.parquet(out).agg(F.count("*").alias("row_count"))
    still = planning.retry_plan(writing.open_failures(entries)).agg(F.count("*").alias("open_after"))
    whole = writing.whole_ranges(entries).select(F.col("from_block").alias("whole_from"), F.col("to_block").alias("whole_to"))
    return counts.crossJoin(still).crossJoin(whole).withColumns(
        {"open_before": F.lit(before).cast("bigint"), "windows": F.lit(planned).cast("bigint")}
    )


_FIRST_BLOCK = "coalesce(from_block, ('0x' || substr(address, 27))::bigint + 17900000)"


@query(
    f""", b as (select chainid, address, {_FIRST_BLOCK} as b0, (select max(block_number) from block_times) as latest from contracts),
holes as (select chainid, address, 'logs' as kind, b0 + x as a, least(b0 + y, latest) as z
    from b cross join (values (20000, 29999), (45000, 99999999)) as v(x, y)
  union all select chainid, address, 'transactions', b0, latest from b)
select chainid, address, kind, a as from_block, z as to_block, s as chunk_start, least(s + 19999, z) as chunk_end
from holes, unnest(generate_series(a, z, 20000)) as g(s) where a <= z""",
    "contracts",
    "block_times",
)
def plan_holes(spark, sf_dir):
    """Ranges that overlap, touch, or end before a hole: only the hole and what follows the last one is planned."""
    contracts = fixture(spark, sf_dir, "contracts").withColumn("to_block", F.lit(None).cast("bigint"))
    creations = landing.creations_from_pages(fixtures.creation_pages(spark, sf_dir))
    latest = fixture(spark, sf_dir, "block_times").groupBy("chainid").agg(F.max("block_number").alias("latest_block"))
    first = lookups.with_creation_block(contracts, creations)
    pieces = F.array(*[
        F.struct((F.col("from_block") + a).alias("a"), (F.col("from_block") + z).alias("z"))
        for a, z in ((30_000, 39_999), (0, 9_999), (40_000, 44_999), (5_000, 19_999), (5_000, 6_000))
    ])
    have = first.select("chainid", "address", F.lit("logs").alias("kind"), F.inline(pieces)).withColumnsRenamed({"a": "from_block", "z": "to_block"})
    return planning.missing_plan(contracts, have, latest, creations)


@query("select 1::bigint as chainid, hash, value, 9::bigint as confirmations from transactions", "transactions")
def load_transactions_twice(spark, sf_dir):
    """The same transactions, later with more confirmations and upper-case addresses: the newest state of each stays."""
    folder, out, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    pages = fixtures.transaction_pages(spark, sf_dir)
    confirmed = lambda n: pages.withColumn("result", F.replace("result", F.lit('"confirmations":""'), F.lit(f'"confirmations":"{n}"')))
    confirmed(5).write.json(folder)
    backfill.load_landing(spark, folder, out, ledger, "transactions")
    confirmed(9).withColumn("address", F.upper("address")).write.mode("append").json(folder)
    backfill.load_landing(spark, folder, out, ledger, "transactions")
    return spark.read.parquet(out).select("chainid", "hash", "value", "confirmations")


@query(
    """, once as (select contract_address, chainid, s as a, least(s + greatest(block_chunk_size // 10, 1000) - 1, to_block) as b
  from failed_ranges, unnest(generate_series(from_block, to_block, greatest(block_chunk_size // 10, 1000))) as g(s)),
sized as (select *, greatest(least(b - a + 1, 20000) // 10, 1000) as w from once)
select contract_address, chainid, w as retry_size, s as chunk_start, least(s + w - 1, b) as chunk_end
from sized, unnest(generate_series(a, b, w)) as g(s)""",
    "failed_ranges",
)
def retry_twice(spark, sf_dir):
    """Windows of a retry that fail again are ledgered with their own width."""
    first = planning.retry_plan(fixture(spark, sf_dir, "failed_ranges"))
    width = F.least(F.col("chunk_end") - F.col("chunk_start") + 1, F.lit(20_000)).cast("bigint")
    again = first.select(
        "contract_address", "chainid", F.col("chunk_start").alias("from_block"), F.col("chunk_end").alias("to_block"), width.alias("block_chunk_size")
    )
    return planning.retry_plan(again).select("contract_address", "chainid", "retry_size", "chunk_start", "chunk_end")


@query(
    """select 9007199254740993 + event_id as exact, -(9007199254740993 + event_id) as cut, case when event_id < 1000 then 1500 + event_id * 1000 end as power
from events"""
)
def whole_numbers(spark, sf_dir):
    """Whole numbers past 2^53 stay exact; fractions are cut; exponents are read."""
    big = F.col("event_id") + F.lit(9007199254740993)
    power = F.when(F.col("event_id") < 1000, F.concat((F.col("event_id") + 1.5).cast("string"), F.lit("e3")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        fn.whole_number(big.cast("string")).alias("exact"),
        fn.whole_number(F.concat(F.lit("-"), big.cast("string"), F.lit(".9"))).alias("cut"),
        fn.whole_number(power).alias("power"),
    )


@query(
    "select hash, block_number, transaction_index from transactions where (block_number, transaction_index) > (18000100, 3) "
    "order by block_number, transaction_index limit 100",
    "transactions",
)
def page_after(spark, sf_dir):
    page = planning.page_after(fixture(spark, sf_dir, "transactions"), ["block_number", "transaction_index"], (18_000_100, 3), 100)
    return page.select("hash", "block_number", "transaction_index")


@query(
    f""", t as (select case when event_id % 3 = 0 then null else chainid end as chainid, case when event_id % 5 = 0 then null else address end as address,
  event_id as block_number from (select *, (block_number - 18000000) * 4 + log_index as event_id from logs)) """
    + _nulls("gaps", chainid="chainid", address="address", block_number="block_number"),
    "logs",
)
def not_null_gaps(spark, sf_dir):
    """Checks that find NULLs in some columns and none in another."""
    event = (F.col("block_number") - 18_000_000) * 4 + F.col("log_index")
    gaps = fixture(spark, sf_dir, "logs").select(
        F.when(event % 3 != 0, F.col("chainid")).alias("chainid"), F.when(event % 5 != 0, F.col("address")).alias("address"), event.alias("block_number")
    )
    return quality.not_null(gaps, "gaps", ("chainid", "address", "block_number"))


# Packing and newest rows.

@query("select chainid, transaction_hash, log_index, address, data, true as packed from logs", "logs")
def compacted_table(spark, sf_dir):
    """Fifty small files a partition become two at most, with the same rows."""
    path = fresh_path(spark, "many-files")
    logs = fixture(spark, sf_dir, "logs").withColumn("block_bucket", tables.block_bucket(F.col("block_number")))
    logs.repartition(50).write.partitionBy("chainid", "block_bucket").parquet(path)
    writing.compact(spark, path, ["address", "block_number", "log_index"], ("transaction_hash",))
    most = writing.partition_files(spark, path).agg(F.max("files").alias("most"))
    rows = spark.read.parquet(path).select("chainid", "transaction_hash", "log_index", "address", "data")
    return rows.crossJoin(F.broadcast(most)).withColumn("packed", F.col("most") <= 2).drop("most")


@query(
    """select chainid, hash, value, case when block_number % 3 = 0 then 9 when block_number % 3 = 1 then 5 else 7 end::bigint as confirmations
from transactions""",
    "transactions",
)
def upsert_newest(spark, sf_dir):
    """Of three fetches of a third each the newest confirmations stay, whatever the order of fetches."""
    path = fresh_path(spark, "newest")
    tx = fixture(spark, sf_dir, "transactions").drop("value_text")
    identity, third = (["chainid", "hash"], ["confirmations"]), F.col("block_number") % 3
    for confirmations, some in ((5, third >= 0), (9, third == 0), (7, third != 1), (3, third == 1)):
        fetch = tx.where(some).withColumn("confirmations", F.lit(confirmations).cast("bigint"))
        writing.upsert(fetch, path, ["block_number"], identity, ("hash",))
    return spark.read.parquet(path).select("chainid", "hash", "value", "confirmations")


@query(
    """select chainid, block_number // 100000 as block_bucket, count(*) as rows, min(block_number) as first_block, max(block_number) as last_block
from logs group by 1, 2""",
    "logs",
)
def stored_extent(spark, sf_dir):
    """Counts and bounds of a stored table's partitions, from footers alone."""
    path = fresh_path(spark, "extent")
    writing.write_table(fixture(spark, sf_dir, "logs"), path, ["address", "block_number"])
    found = tables.stored_extent(spark, path)
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("chainid", "block_bucket")})


# Catalog tables.

@query("select true as exists_after, false as exists_before, count(*) as row_count, 0::bigint as rows_before from logs", "logs")
def catalog_table(spark, sf_dir):
    """A saved model is there, is counted, and holds what was saved."""
    name = "model_" + fresh_path(spark, "x").rsplit("-", 1)[1]
    before, none = tables.table_exists(spark, name), tables.row_count(spark, name)
    writing.save_model(fixture(spark, sf_dir, "logs"), name, ["address"])
    after, n = tables.table_exists(spark, name), tables.row_count(spark, name)
    out = spark.table(name).groupBy().agg(F.count("*").alias("row_count"))
    assert n == out.first()[0]
    return out.select(F.lit(after).alias("exists_after"), F.lit(before).alias("exists_before"), "row_count", F.lit(none).cast("bigint").alias("rows_before"))


_BROKEN_LOGS = """select * replace (case when ((block_number - 18000000) * 4 + log_index) % 13 = 5 then '["0xdd' else topics end as topics) from logs"""
_SOUND = "(select * from logs where ((block_number - 18000000) * 4 + log_index) % 13 <> 5)"


@query(
    f""", d as ({_DECODED.replace("from logs", f"from {_SOUND}")}), t as (select * from d) """
    + _nulls("decoded_logs", **{c: c for c in ("chainid", "address", "block_number", "transaction_hash")})
    + f""" union all select "table", "column", violations, passed from (with t as (select * from d where topic0 = '{TRANSFER_TOPIC}') """
    + _nulls(
        "erc20_transfer",
        chainid="chainid",
        token_address="address",
        from_address="topic1",
        to_address="topic2",
        block_number="block_number",
        datetime="datetime",
        transaction_hash="transaction_hash",
    )
    + """) union all select 'logs', 'topics', n, n = 0 from (
  select count(*) as n from logs where ((block_number - 18000000) * 4 + log_index) % 13 = 5)""",
    "logs",
)
def model_checks(spark, sf_dir):
    """Both models built as tables; logs with broken topics are rejected and fail a check."""
    event = (F.col("block_number") - 18_000_000) * 4 + F.col("log_index")
    logs = fixture(spark, sf_dir, "logs").withColumn("topics", F.when(event % 13 == 5, '["0xdd').otherwise(F.col("topics")))
    return models.build_models(logs, "models_" + fresh_path(spark, "x").rsplit("-", 1)[1])


@query(
    """select 'c' || c_custkey::varchar as name, '0x' || lpad(lower(to_hex(c_custkey)), 40, '0') as address,
  case when c_custkey % 2 = 0 then 'base' else 'ethereum' end as chain from customer"""
)
def contract_manifest(spark, sf_dir):
    """Manifests of a nation's contracts each, read from their files."""
    key, folder = F.col("c_custkey"), fresh_path(spark, "manifest")
    contract = F.struct(
        F.concat(F.lit("0x"), F.lpad(F.hex(key), 40, "0")).alias("address"), F.when(key % 2 == 0, "base").otherwise("ethereum").alias("chain")
    )
    entry = F.struct(F.concat(F.lit("c"), key.cast("string")).alias("name"), contract.alias("contract"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy("c_nationkey")
    texts = customers.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    texts.write.partitionBy("c_nationkey").text(folder)
    return reference_data.manifest(spark, folder)


@query(
    f"""with {_OWN_EVENTS} select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address, event_name, topic0, event_signature from own"""
)
def saved_events(spark, sf_dir):
    """The event catalog written and read back."""
    folder = fresh_path(spark, "events")
    catalog.save_events(catalog.event_catalog(reference_data.abi_entries(fixture(spark, sf_dir, "abis"))), folder)
    return spark.read.parquet(folder).select("address", "event_name", "topic0", "event_signature")


@query(
    f""", d as ({_DECODED}), n as (select count(*) as n, count(topic0) as t0, count(topic1) as t1, count(topic2) as t2, count(topic3) as t3 from d)
select 'decoded_logs' as "table", c as "column", declared, present, case when present then filled end as filled from n, lateral (values
  ('chainid', true, true, n), ('address', true, true, n), ('block_number', true, true, n), ('transaction_hash', true, true, n),
  ('log_index', true, true, n), ('event_name', true, false, 0), ('event_signature', true, false, 0), ('decoded_data', true, false, 0),
  ('topic0', false, true, t0), ('topic1', false, true, t1), ('topic2', false, true, t2), ('topic3', false, true, t3), ('data', false, true, n),
  ('datetime', false, true, n)) as v(c, declared, present, filled)""",
    "logs",
)
def declared_columns(spark, sf_dir):
    """What the model declares, what it has, and how far each column is filled."""
    return quality.column_profile(models.decoded_logs(fixture(spark, sf_dir, "logs")), "decoded_logs")


@query(
    """select '0x' || lpad(lower(to_hex(s_suppkey)), 40, '0') as address,
  case when s_suppkey % 2 = 1 then '0x' || lpad(lower(to_hex(s_suppkey + 900)), 40, '0') end as implementation_address from supplier"""
)
def proxy_first(spark, sf_dir):
    """Of several implementations the first on file counts, though a later one is smaller."""
    folder, key = fresh_path(spark, "proxies"), F.col("s_suppkey")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    hexed = lambda n: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(n)), 40, "0"))
    for name, more in (("a", 900), ("b", 1), ("c", 2000)):
        pairs = supplier.select(hexed(key).alias("address"), F.when(key % 2 == 1, hexed(key + more)).otherwise("None").alias("implementation_address"))
        pairs.coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    links = reference_data.proxy_pairs(spark, f"{folder}/*")
    return lookups.with_implementation(supplier.select(hexed(key).alias("address")), links)


# Streams.

def _landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages landed twice, the last blocks first, in many triggers."""
    return landing.stream_pages(spark, fixtures.landed_folder(spark, sf_dir), files_per_trigger=2)


@query(
    f"select 1::bigint as chainid, transaction_hash, log_index, address from logs where {_GOOD_PAGE}", "logs"
)
def stream_dedup_logs(spark, sf_dir):
    rows = landing.warehouse_logs(landing.logs_from_pages(_landed_stream(spark, sf_dir)))
    out, checkpoint = fresh_path(spark, "deduplicated"), fresh_path(spark, "checkpoint")
    ingest.append_available(rows, out, checkpoint, ["address", "block_number", "log_index"])
    return spark.read.parquet(out).select("chainid", "transaction_hash", "log_index", "address")


@query(_odd_failures("(2, 3, 5)"))
def stream_rejects(spark, sf_dir):
    """Streamed pages that are refused, broken or of unknown chains are ledgered as a batch load's are."""
    folder, out, ledger, checkpoint = (fresh_path(spark, n) for n in ("landing", "table", "ledger", "checkpoint"))
    fixtures.odd_log_pages(spark, sf_dir).repartition(4).write.json(folder)
    pages = landing.stream_pages(spark, folder, files_per_trigger=2)
    ingest.load_available(pages, out, ledger, checkpoint, page_rows=1001)
    return writing.open_failures(spark.read.parquet(ledger))


@query(
    f"""select 1::bigint as chainid, address, topic0, data, datetime, transaction_hash, log_index
from ({_DECODED.replace("from logs where", "from logs where " + _GOOD_PAGE + " and")})""",
    "logs",
)
def stream_decoded_logs(spark, sf_dir):
    rows = landing.to_table_names(landing.logs_from_pages(_landed_stream(spark, sf_dir)))
    out, checkpoint = fresh_path(spark, "decoded"), fresh_path(spark, "checkpoint")
    ingest.append_available(rows, out, checkpoint, ["address", "block_number"], each=models.decoded_logs)
    return spark.read.parquet(out).select(
        "chainid", "address", "topic0", "data", "datetime", "transaction_hash", "log_index"
    )
