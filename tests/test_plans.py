"""Models, catalog, metric feeds and landing loads, with plan checks."""

import datetime
import json
import os

import pytest
from blockloom import schemas
from blockloom.constants import TRANSFER_TOPIC
from blockloom.functions.hashing import keccak256
from blockloom.operators import planning, writing
from blockloom.plans import backfill, catalog, metrics, models
from blockloom.session import fresh_path, stage
from blockloom.sources import landing, reference_data
from conftest import plan_text
from pyspark.sql import functions as F
from workload import fixtures


@pytest.fixture(scope="module")
def logs(spark, sf_dir):
    return fixtures.fixture(spark, sf_dir, "logs")


# Models.

def test_topics_are_parsed_once(logs):
    plan = plan_text(models.decoded_logs(logs))
    assert plan.count("from_json") == 1
    assert plan_text(models.erc20_transfer(logs)).count("from_json") == 1


def test_array_and_json_topics_give_the_same_rows(logs):
    arrays = logs.withColumn("topics", F.from_json("topics", "array<string>"))
    a, b = models.erc20_transfer(logs), models.erc20_transfer(arrays)
    assert a.schema == b.schema
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "from_json" not in plan_text(models.decoded_logs(arrays)).split("Scan")[0].split("Project")[1]


def test_escaped_topic_text_is_found(spark, logs):
    escaped = TRANSFER_TOPIC.replace("0xd", "0x\\u0064", 1)
    one = logs.limit(1).withColumn("topics", F.lit(f'["{escaped}"]'))
    assert models.logs_with_topic(one, TRANSFER_TOPIC).count() == 1


def test_transfer_and_decoded_agree(logs):
    direct = models.erc20_transfer(logs)
    staged = models.transfers(models.decoded_logs(logs))
    assert direct.exceptAll(staged).count() == 0 and direct.count() == staged.count()


def test_build_models_writes_tables_that_prune(spark, logs):
    checks = models.build_models(logs, "staging_test")
    assert {r.table for r in checks.collect()} == {"decoded_logs", "erc20_transfer", "logs"}
    assert all(r.passed for r in checks.collect())
    decoded = spark.table("staging_test.decoded_logs")
    assert decoded.count() == models.decoded_logs(logs).count()
    plan = plan_text(models.transfers(decoded).select("amount_hex", "block_number"))
    assert f"EqualTo(topic0,{TRANSFER_TOPIC})" in plan
    assert "topic2:string" not in plan.split("ReadSchema")[1]
    moved = spark.table("staging_test.erc20_transfer")
    assert moved.count() == models.erc20_transfer(logs).count()
    models.build_models(logs, "staging_test")
    assert spark.table("staging_test.erc20_transfer").count() == moved.count()


def test_build_models_rejects_broken_topics(spark, logs):
    broken = logs.limit(3).withColumn("topics", F.lit('["0x'))
    checks = {(r.table, r.column): r for r in models.build_models(logs.unionByName(broken), "staging_broken").collect()}
    assert checks["logs", "topics"].violations == 3 and not checks["logs", "topics"].passed
    assert spark.table("staging_broken.rejected_logs").count() == 3
    arrays = logs.withColumn("topics", F.from_json("topics", "array<string>"))
    assert models.build_models(arrays, "staging_arrays").where("table = 'logs'").first().violations == 0


# Catalog.

ABI = [
    {
        "type": "event",
        "name": "Filled",
        "inputs": [
            {"name": "id", "type": "uint256", "indexed": True},
            {
                "name": "order",
                "type": "tuple[]",
                "indexed": False,
                "components": [
                    {"name": "who", "type": "address"},
                    {"name": "legs", "type": "tuple", "components": [{"name": "a", "type": "int8"}, {"name": "b", "type": "bytes4[2]"}]},
                ],
            },
        ],
    },
    {"type": "event", "name": "Empty", "inputs": [], "anonymous": True},
    {"type": "function", "name": "Filled", "inputs": []},
    {"type": "constructor", "inputs": []},
]


def write_abi(folder, address, entries):
    with open(os.path.join(folder, f"{address}.json"), "w") as f:
        json.dump(entries, f, indent=2)


def test_event_catalog_from_files(spark, tmp_path):
    write_abi(tmp_path, "0xAa", ABI)
    write_abi(tmp_path, "0xbb", ABI[1:2])
    pairs = tmp_path / "implementation.csv"
    pairs.write_text("address,implementation_address\n0xbb,0xaa\n0xbb,0xaa\n0xaa,None\n")
    entries = reference_data.abi_files(spark, str(tmp_path))
    links = reference_data.proxy_pairs(spark, str(pairs))
    assert links.count() == 2
    events = catalog.event_catalog(catalog.combined_abi(entries, links))
    signature = "Filled(uint256,(address,(int8,bytes4[2]))[])"
    got = sorted((r.address, r.event_name, r.event_signature, r.topic0, r.anonymous) for r in events.collect())
    filled = ("Filled", signature, keccak256([signature.encode()])[0], False)
    empty = ("Empty", "Empty()", keccak256([b"Empty()"])[0], True)
    folder = fresh_path(spark, "events")
    catalog.save_events(events, folder)
    stored = spark.read.parquet(folder).where("address = '0xbb'")
    assert "EqualTo(address,0xbb)" in plan_text(stored) and stored.count() == 3
    assert got == sorted([("0xaa", *filled), ("0xaa", *empty), ("0xbb", *empty), ("0xbb", *filled), ("0xbb", *empty)])


def test_parameters_without_type_or_members_have_no_signature(spark):
    parts = [{"name": "t", "type": "tuple"}, {"name": "u"}, {"name": "v", "type": "tuple", "components": [{"name": "w", "type": "tuple[]"}]}]
    for part in parts:
        text = json.dumps([{"type": "event", "name": "Odd", "inputs": [part]}])
        df = spark.createDataFrame([("0xa", text)], "address string, value string")
        found = catalog.event_catalog(reference_data.abi_entries(df)).first()
        assert (found.event_name, found.event_signature, found.topic0) == ("Odd", None, None)


def word(number):
    return f"{number % (1 << 256):064x}"


def test_decoded_params_of_every_kind(spark):
    inputs = [
        ("who", "address", True), ("count", "int16", False), ("ok", "bool", False), ("pair", "uint8[2]", False),
        ("note", "string", False), ("", "bytes4", False), ("who", "uint256", False), ("list", "uint8[]", False),
        ("tag", "string", True),
    ]
    abi = [{"type": "event", "name": "All", "inputs": [{"name": n, "type": t, "indexed": i} for n, t, i in inputs]}]
    entries = reference_data.abi_entries(spark.createDataFrame([("0xa", json.dumps(abi))], "address string, value string"))
    events = catalog.event_catalog(entries)
    topic0 = events.first().topic0
    head = [word(-5), word(1), word(7), word(8), word(8 * 32), "deadbeef" + "0" * 56, word(1 << 200), word(99)]
    data = "0x" + "".join(head) + word(5) + b"hello".hex().ljust(64, "0")
    schema = "address string, topic0 string, topic1 string, topic2 string, topic3 string, data string, transaction_hash string, log_index int"
    party, tag = "0x" + "0" * 24 + "12" * 20, "0x" + "ab" * 32
    decoded = spark.createDataFrame(
        [("0xa", topic0, party, tag, None, data, "t", 1), ("0xz", topic0, party, tag, None, "0x", "t", 2),
         ("0xa", "0xother", None, None, None, "0x", "t", 3), ("0xa", topic0, party, None, None, "0x", "t", 4)],
        schema,
    )
    got = {r.log_index: r for r in catalog.described_logs(decoded, events).collect()}
    assert got[3].decoded_data is None and got[3].event_name is None
    assert got[1].event_name == got[2].event_name == "All"
    assert json.loads(got[1].decoded_data) == {
        "who": "0x" + "12" * 20, "count": "-5", "ok": "true", "pair": '["7","8"]',
        "note": "0x" + b"hello".hex(), "arg5": "0xdeadbeef", "who_6": str(1 << 200), "list": None, "tag": tag,
    }
    assert json.loads(got[2].decoded_data)["who"] == "0x" + "12" * 20
    assert json.loads(got[2].decoded_data)["count"] is None
    # Fewer topics than indexed parameters: another layout, of which nothing is known.
    assert got[4].event_name == "All" and got[4].decoded_data is None


@pytest.mark.parametrize(
    ("kind", "words", "value"),
    [
        ("uint256[]", [32, 2, 7, 9], ["7", "9"]),
        ("address[2]", [1, 2], ["0x" + "0" * 39 + "1", "0x" + "0" * 39 + "2"]),
        ("(uint8,bool)", [5, 1], ["5", "true"]),
        ("(uint8,bytes)", [32, 5, 64, 3, int("abcdef" + "0" * 58, 16)], ["5", "0xabcdef"]),
        ("(uint8,uint8[])[]", [32, 2, 64, 160, 1, 64, 0, 2, 64, 1, 3], [["1", []], ["2", ["3"]]]),
        ("uint256[]", [32, 3, 7, 9], None),
        ("uint256[]", [1 << 200, 2, 7, 9], None),
        ("uint256[][]", [32, 2, 0, 0], None),
        ("uint256[][]", [32, 2, 64, 64, 2, 7, 9], [["7", "9"], ["7", "9"]]),
        ("int16[2][]", [32, 1, (1 << 256) - 3, 4], [["-3", "4"]]),
    ],
)
def test_arrays_and_tuples(kind, words, value):
    data = catalog._Data(bytes.fromhex("".join(word(w) for w in words)))
    if value is None:
        with pytest.raises(ValueError):
            data.read(kind, 0, 0)
    else:
        assert data.read(kind, 0, 0) == value


@pytest.mark.parametrize("depth", [0, 1, 4, 7])
def test_tuples_of_any_depth_have_a_signature(spark, depth):
    part, kind = {"name": "x", "type": "uint256"}, "uint256"
    for _ in range(depth):
        part, kind = {"name": "t", "type": "tuple[]", "components": [part, {"name": "y", "type": "bool"}]}, f"({kind},bool)[]"
    abi = json.dumps([{"type": "event", "name": "Deep", "inputs": [part]}])
    texts = spark.createDataFrame([("0xa", abi), ("0xb", "no json"), ("0xc", None)], "address string, value string")
    found = catalog.event_catalog(reference_data.abi_entries(texts)).collect()
    assert [r.event_signature for r in found] == [f"Deep({kind})"] and found[0].topic0 is not None


def test_labels_are_broadcast(spark, sf_dir, logs):
    entries = reference_data.abi_entries(fixtures.fixture(spark, sf_dir, "log_abis"))
    plan = plan_text(catalog.label_events(models.decoded_logs(logs), catalog.event_catalog(entries)))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


# Metric feeds: edges the generated inputs lack.

def payload(spark, document, **columns):
    df = spark.createDataFrame([(json.dumps(document),)], "payload string")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def test_history_survives_bad_members(spark):
    doc = {"chainBalances": {"A": {"tokens": [{"date": 1, "circulating": {"p": None}}, {"date": 2}]}, "B": 5,
                             "C": {"tokens": [{"date": "2024-01-01", "circulating": {"p": -2.9, "q": 1}}]}}}
    got = {(r.chain, r.circulating, r.timestamp) for r in metrics.stablecoin_history(payload(spark, doc)).collect()}
    assert got == {("A", None, datetime.datetime(1970, 1, 1, 0, 0, 1)), ("C", -2, datetime.datetime(2024, 1, 1))}
    assert metrics.stablecoin_history(payload(spark, {"name": "x"})).count() == 0


def test_current_balances_default_to_now(spark):
    doc = {"currentChainBalances": {"A": {"p": 3.7}, "B": {}, "C": [1], "D": None}}
    row = metrics.stablecoin_current(payload(spark, doc, id=7)).collect()
    assert [(r.id, r.chain, r.circulating) for r in row] == [(7, "A", 3)]
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((now - row[0].timestamp).total_seconds()) < 600


def test_assets_without_peg_or_amounts(spark):
    doc = {"peggedAssets": [{"pegType": "", "name": "a"}, {"pegType": "p", "circulating": 5}, {"pegType": None}, {"name": "b"},
                            {"pegType": "p", "circulating": {"p": 2}, "circulatingPrevMonth": {"q": 1}, "extra": {"k": [1]}}]}
    got = metrics.stablecoins_metadata(payload(spark, doc)).orderBy("circulating").collect()
    assert [(r.circulating, r.circulating_prev_month) for r in got] == [(None, None), (2.0, None)]
    assert got[1].other_fields == {"extra": '{"k":[1]}'}


def test_token_price_without_prices(spark):
    for coins in ({}, {"ethereum:0xa": {"symbol": "S", "prices": []}}, {"ethereum:0xa": {"symbol": "S"}}, {"base:0xa": {"prices": [{"price": 1}]}}):
        df = payload(spark, {"coins": coins}, network="ethereum", contract_address="0xa")
        assert metrics.token_price(df).count() == 0


def test_revenue_skips_odd_points(spark):
    doc = {"totalDataChart": [[1, 2.5], [1], 5, [2, None], "x"], "totalDataChartBreakdown": [[1, {"A": {"v": 1}, "B": 2, "C": {}}], [2, 3], [3]], "name": "n"}
    total = metrics.revenue_total(payload(spark, doc, protocol="p"), include_metadata=True).collect()
    assert sorted((r.revenue is None, r.revenue or 0) for r in total) == [(False, 2.5), (True, 0)]
    assert total[0].metadata == {"name": "n"}
    parts = metrics.revenue_breakdown(payload(spark, doc, protocol="p")).collect()
    assert [(r.chain, r.sub_protocol, r.revenue) for r in parts] == [("A", "v", 1.0)]


def test_yield_rows(spark):
    doc = {"data": [{"pool": "a", "rewardTokens": None, "x": 1}, {"pool": "b", "rewardTokens": ["t"], "tvlUsd": 1e9}]}
    got = metrics.yield_pools(payload(spark, doc)).orderBy("pool").collect()
    assert [(r.reward_tokens, r.underlying_tokens, r.tvl_usd, r.other_fields) for r in got] == [
        ("[]", "[]", None, {"x": "1"}), ('["t"]', "[]", 1e9, {})]


def test_read_payloads_adds_columns(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data":[]}\n{"data":[]}\n')
    got = metrics.read_payloads(spark, str(tmp_path), pool_id="p", pool_name="n")
    assert [(r.pool_id, r.pool_name) for r in got.collect()] == [("p", "n")] * 2


# Landing to table.

def land(pages, folder):
    pages.write.mode("append").json(folder)


def test_load_landing_resume_and_retry(spark, sf_dir):
    folder, table, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    pages = fixtures.log_pages(spark, sf_dir)
    land(pages, folder)
    first = backfill.load_landing(spark, folder, table, ledger)
    whole = fixtures.fixture(spark, sf_dir, "logs").count()
    assert 0 < first.rows_added <= whole and first.failed_ranges == 1
    assert backfill.load_landing(spark, folder, table, ledger).rows_added == 0
    chunks = planning.retry_plan(writing.open_failures(spark.read.parquet(ledger)))
    assert chunks.agg(F.min("chunk_start"), F.max("chunk_end")).first()[:] == (18_000_000, 19_000_000)
    retried = fresh_path(spark, "landing")
    land(fixtures.log_pages(spark, sf_dir, rejects=False), retried)
    backfill.load_landing(spark, retried, table, ledger)
    assert spark.read.parquet(table).count() == whole
    top = planning.resume_blocks(spark.read.parquet(table)).collect()
    assert max(r.max_block for r in top) == 18_000_000 + (whole - 1) // 4


def test_a_load_opens_new_files_only(spark, sf_dir):
    folder, table, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    pages = fixtures.log_pages(spark, sf_dir, rejects=False)
    for _ in range(3):
        land(pages, folder)
    backfill.load_landing(spark, folder, table, ledger)
    assert backfill.new_files(spark, folder, ledger, "logs").count() == 0
    # Old files that cannot be read any more do no harm: nobody opens them.
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = {str(f.getPath()): f.getModificationTime() for f in fs.listStatus(path)}
    land(fixtures.empty_page(spark, sf_dir), folder)
    new = [r.path for r in backfill.new_files(spark, folder, ledger, "logs").collect()]
    assert new and not {p.split(":", 1)[-1] for p in new} & {p.split(":", 1)[-1] for p in before}
    listing = plan_text(backfill.new_files(spark, folder, ledger, "logs"))
    assert "binaryFile" in listing and "FileScan json" not in listing
    loaded = backfill.load_landing(spark, folder, table, ledger)
    assert loaded == backfill.Load(0, 0)
    assert writing.whole_ranges(spark.read.parquet(ledger)).count() == 1


def test_a_retry_in_windows_settles_the_range(spark, sf_dir):
    folder, table, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    land(fixtures.broken_page(spark, sf_dir), folder)
    assert backfill.load_landing(spark, folder, table, ledger).failed_ranges == 1
    windows = planning.retry_plan(writing.open_failures(spark.read.parquet(ledger))).select("chunk_start", "chunk_end")
    pages = fixtures.window_pages(spark, sf_dir, windows)
    # All windows but one: the range stays open; with the last one it is settled.
    last = F.col("from_block") == windows.agg(F.max("chunk_start")).first()[0]
    land(pages.where(~last), folder)
    backfill.load_landing(spark, folder, table, ledger)
    assert writing.open_failures(spark.read.parquet(ledger)).count() == 1
    land(pages.where(last), folder)
    backfill.load_landing(spark, folder, table, ledger)
    assert writing.open_failures(spark.read.parquet(ledger)).count() == 0
    whole = [r[:] for r in writing.whole_ranges(spark.read.parquet(ledger)).select("from_block", "to_block").collect()]
    assert whole == [(18_000_000, 19_000_000)]
    assert spark.read.parquet(table).count() == fixtures.fixture(spark, sf_dir, "logs").count()


def test_load_transactions(spark, sf_dir):
    folder, table, ledger = (fresh_path(spark, n) for n in ("landing", "table", "ledger"))
    land(fixtures.transaction_pages(spark, sf_dir), folder)
    loaded = backfill.load_landing(spark, folder, table, ledger, "transactions")
    assert loaded.rows_added == fixtures.fixture(spark, sf_dir, "transactions").count()


def test_envelope_edges(spark):
    rows = [("1", "OK", "[]"), ("0", "No rate Limit", "x"), ("0", None, None), (None, "OK", '[{"data":"0x"}]'), ("1", "OK", "oops"), ("1", "OK", None)]
    pages = spark.createDataFrame(rows, "status string, message string, result string")
    assert landing.good_pages(pages).count() == 2
    kinds = sorted(r.error_kind for r in landing.rejected_pages(pages).collect())
    assert kinds == ["api_error", "malformed_result", "malformed_result", "rate_limit"]


def test_page_completeness_cases(spark):
    full, part = json.dumps([{}] * 3), json.dumps([{}])
    rows = [("a", 1, full), ("a", 2, part), ("b", 1, full), ("c", 2, part), ("d", 1, "[]"), ("a", 1, full)]
    pages = spark.createDataFrame(rows, "address string, page bigint, result string").withColumns(
        {"status": F.lit("1"), "message": F.lit("OK"), "chain": F.lit("base"), "from_block": F.lit(0), "to_block": F.lit(1)}
    )
    got = {r.address: (r.row_count, r.complete) for r in landing.page_completeness(pages, 3).collect()}
    assert got == {"a": (4, True), "b": (3, False), "c": (1, False), "d": (0, True)}


def test_receipt_files(spark, tmp_path):
    doc = {"transactionHash": "ab", "logs": [{"address": "0x1", "topics": ["0xt"], "data": "0x", "blockNumber": "0x10", "logIndex": "0x0", "transactionHash": "0xab"}]}
    (tmp_path / "0xab.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "bad.json").write_text("null")
    found = landing.receipts(spark, str(tmp_path))
    assert [r.transactionHash for r in found.collect()] == ["0xab"]
    log = landing.logs_from_receipts(found).first()
    assert (log.block_number, log.log_index, log.topics) == (16, 0, ["0xt"])


def test_manifest_and_chain_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "one": {"address": "0xAB", "chain": "ethereum"}\n}')
    assert reference_data.manifest(spark, str(tmp_path / "c.json")).collect()[0][:] == ("one", "0xab", "ethereum")
    texts = spark.createDataFrame([('{"a": 1, "b": 37714555429}',)], "value string")
    assert sorted(r[:] for r in reference_data.chains_from_json(texts).collect()) == [("a", 1), ("b", 37714555429)]


def test_table_names(spark):
    raw = spark.createDataFrame([], schemas.RAW_TRANSACTION)
    names = landing.to_table_names(raw).columns
    assert {"hash", "from_address", "to_address", "gas_price", "time_stamp"} <= set(names)
    assert not [n for n in names if n != n.lower()]


def test_data_that_asks_for_far_more_than_it_holds_is_refused():
    """Nested lists whose items all point at one list multiply at each level."""
    words = [32]
    for level in range(6):
        words += [8] + [8 * 32] * 8
    words += [8] + [1] * 8
    with pytest.raises(ValueError):
        catalog._Data(bytes.fromhex("".join(word(w) for w in words))).read("uint256" + "[]" * 7, 0, 0)


def test_plain_values_equal_those_of_columns():
    import pyarrow as pa

    words = [word(n) for n in (0, 1, 255, 1 << 200, (1 << 256) - 5)] + ["ab" * 32]
    for kind in ("address", "bool", "uint8", "uint256", "int256", "bytes4", "bytes32", "function"):
        assert [catalog._plain_value(bytes.fromhex(w), kind) for w in words] == catalog._values_of_kind(pa.array(words), kind).to_pylist()


_PAGE = "status string, message string, result string, address string, chain string, from_block long, to_block long, page long"
_LOG = '{"blockNumber":"0x5","transactionHash":"0x1","logIndex":"0x%d","topics":["0xt"]}'
_ODD_RESULTS = [f"[{_LOG % 0},{_LOG % 1}]", "[]", "[null]", "[5]", f"[{_LOG % 2},5]", None, "Error!", f"[{_LOG % 3}", f"[{_LOG % 0},{_LOG % 1}]"]


def _odd_results(spark):
    rows = [("1", "OK", text, "0xA", chain, 0, 9, page % 8) for page, text in enumerate(_ODD_RESULTS) for chain in ("ethereum", "nowhere", None)]
    return spark.createDataFrame(rows, _PAGE)


@pytest.mark.parametrize("kind", ["logs", "transactions"])
def test_opened_pages_give_the_rows_and_states_of_the_pages(spark, kind):
    pages = _odd_results(spark)
    opened = stage(landing.typed_elements(landing.opened_pages(pages, backfill.ELEMENT[kind]), kind), "opened")
    state, expected = landing.opened_state(opened), landing.page_state(pages, backfill.ELEMENT[kind])
    assert sorted(map(str, state.collect())) == sorted(map(str, expected.collect()))
    rows = opened.where("_page.sound").drop("_page")
    if kind == "logs":
        plain = landing.warehouse_logs(landing.logs_from_pages(pages))
    else:
        plain = landing.warehouse_transactions(landing.transactions_from_pages(pages))
    assert rows.columns == plain.columns and plain.count() == rows.count() > 0
    assert rows.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("kind", ["logs", "transactions"])
def test_a_load_reads_its_pages_once(spark, kind):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    # The copy is on disk, the count is of rows that were asked of it.
    pages = stage(_odd_results(spark), "pages")
    table, ledger = fresh_path(spark, "table"), fresh_path(spark, "ledger")
    counted = pages.withColumn("result", F.udf(seen, "string").asNondeterministic()("result"))
    backfill.load_pages(counted, table, ledger, kind)
    assert read.value == pages.count()
