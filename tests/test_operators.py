"""Operators on small hand-made inputs, against brute force where SQL is long."""

import datetime
import os
import random

import pytest
from blockloom.constants import CHAIN_IDS
from blockloom.operators import block_time, dedup, joins, lookups, planning, quality, ranges, writing
from blockloom.session import fresh_path, stage, unstage, work_folder
from blockloom.sources import reference_data, tables
from conftest import plan_text
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_chain_id_takes_exactly_one_argument():
    assert reference_data.chain_id(chain="base") == 8453
    assert reference_data.chain_id(chainid=7) == 7
    for bad in ({}, {"chain": "base", "chainid": 1}, {"chain": "nowhere"}):
        with pytest.raises(ValueError):
            reference_data.chain_id(**bad)


def test_chains_are_broadcast_and_wide_enough(spark):
    df = spark.createDataFrame([("ethereum",), ("xai_sepolia_testnet",), ("x",)], "chain string")
    known = lookups.with_chain_id(df)
    assert rows(known.select("chainid")) == [(1,), (37714555429,)]
    assert "BroadcastHashJoin" in plan_text(known)
    assert rows(lookups.unknown_chains(df)) == [("x",)]
    assert reference_data.chains(spark).count() == len(CHAIN_IDS) == 71


def test_label_join_forms_agree_under_skew(spark):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("k"),
        F.col("id").alias("v"),
    )
    labels = spark.createDataFrame(
        [("hot", "H", 1), ("k2", "two", None), ("k5", None, 3), ("unused", "u", 4)], "k string, label string, n int"
    )
    small = joins.label_join(facts, labels, ["k"])
    large = joins.label_join(facts, labels, ["k"], broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan_text(small)
    assert rows(small.select("k", "v", "label", "n")) == rows(large.select("k", "v", "label", "n"))
    assert large.count() == 6000 and large.columns == ["k", "v", "label", "n"]
    unlabelled_hot = joins.label_join(facts, labels.where("k <> 'hot'"), ["k"], broadcast_bytes=0)
    assert unlabelled_hot.where("k = 'hot' and label is null").count() == 2000


def test_label_join_multiplies_by_repeated_labels(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    labels = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, label string")
    got = joins.label_join(facts, labels, ["k"], broadcast_bytes=0)
    expected = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 2, "y"), ("b", 3, None)]
    assert rows(got) == sorted(expected, key=repr)


def test_new_rows_treats_null_as_equal(spark):
    schema = "a int, b string, c array<string>"
    stored = spark.createDataFrame([(1, None, ["x"]), (2, "b", None)], schema)
    fetched = spark.createDataFrame([(1, None, ["x"]), (2, "b", None), (3, None, None), (3, None, None), (1, "n", ["x"])], schema)
    assert rows(dedup.new_rows(fetched, stored)) == [(1, "n", ["x"]), (3, None, None)]
    assert rows(dedup.rows_added(fetched, stored)) == [(2, 2, 4)]
    assert rows(dedup.rows_added(fetched.where("false"), stored.where("false"))) == [(0, 0, 0)]


def test_new_rows_is_one_hash_aggregate(spark):
    stored = spark.range(10).select("id", F.lit("x").alias("b"))
    plan = plan_text(dedup.new_rows(stored, stored))
    assert "Join" not in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_possible_copies_keep_every_match(spark):
    stored = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (None, None)], "a int, b string")
    fetched = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    kept = dedup.possible_copies(stored, fetched, 3)
    assert rows(kept) == sorted([(1, None), (None, None)], key=repr)
    assert rows(dedup.new_rows(fetched, kept)) == rows(dedup.new_rows(fetched, stored)) == [(2, "x")]


def test_the_sketch_keeps_rows_that_cannot_match_out(spark):
    stored = spark.range(40_000).select("id", F.concat(F.lit("x"), F.col("id")).alias("b"))
    fetched = stored.where("id % 4 = 0")
    kept = dedup.possible_copies(stored, fetched, 10_000)
    assert kept.where("id % 4 = 0").count() == 10_000 and kept.where("id % 4 > 0").count() < 3_000
    # However many rows are fetched, the sketch has no more words than its size allows.
    assert dedup.sketch_bits(10**12) == dedup.MOST_BITS
    plan = plan_text(dedup.new_rows(fetched, kept))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_sketch_goes_about_in_pages(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("hash")).unionByName(spark.createDataFrame([(-1,), (0,)], "hash long"))
    words = dedup.sketch(hashes, 1 << 20)
    pages = dedup.sketch_pages(words)
    assert pages.count() <= (1 << 20) / 64 / dedup.PAGE_WORDS
    back = pages.select("page", F.posexplode("words").alias("at", "bits")).where("bits <> 0")
    assert back.select((F.col("page") * dedup.PAGE_WORDS + F.col("at")).alias("word"), "bits").exceptAll(words).isEmpty()
    assert back.count() == words.count() > 2000


def test_appends_with_a_full_sketch_agree(spark, monkeypatch):
    path = fresh_path(spark, "table")
    monkeypatch.setattr(dedup, "MOST_BITS", 64)
    assert writing.append_new(sample_logs(spark, 0, 300), path, ["address"]) == 300
    assert writing.append_new(sample_logs(spark, 200, 400), path, ["address"]) == 100
    assert writing.append_new(sample_logs(spark, 0, 0), path, ["address"]) == 0
    assert spark.read.parquet(path).count() == 400


def test_union_keeps_columns_of_one_side(spark):
    a = spark.createDataFrame([(1, "x")], "k int, old string")
    b = spark.createDataFrame([(1, "y"), (1, "y")], "k int, new string")
    assert dedup.union_distinct(a, b).count() == 2


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [(1, "h", 3, "a"), (1, "h", 9, "b"), (1, None, 1, "n1"), (1, None, 2, "n2"), (2, "h", None, "c")],
        "chainid int, hash string, confirmations int, v string",
    )
    got = dedup.latest_by_key(df, ["chainid", "hash"], ["confirmations"])
    assert rows(got) == sorted([(1, "h", 9, "b"), (1, None, 2, "n2"), (2, "h", None, "c")], key=repr)
    assert got.columns == df.columns
    assert "Window" not in plan_text(got)


def test_split_ranges_edges(spark):
    df = spark.createDataFrame(
        [("a", 0, 9), ("b", 5, 5), ("c", 6, 5), ("d", None, 5), ("e", 0, 10)], "k string, from_block bigint, to_block bigint"
    )
    got = rows(planning.split_ranges(df, 5).select("k", "chunk_start", "chunk_end"))
    expected = [("a", 0, 4), ("a", 5, 9), ("b", 5, 5), ("e", 0, 4), ("e", 5, 9), ("e", 10, 10)]
    assert got == sorted(expected, key=repr)


def test_fetch_plan_start_order(spark):
    contracts = spark.createDataFrame(
        [(1, "0xA", 100, None), (1, "0xb", None, 30), (1, "0xc", None, None), (1, "0xd", 7, None)],
        "chainid bigint, address string, from_block bigint, to_block bigint",
    )
    stored = spark.createDataFrame([(1, "0xa", "logs", 150)], "chainid bigint, address string, kind string, max_block bigint")
    latest = spark.createDataFrame([(1, 160)], "chainid bigint, latest_block bigint")
    creations = spark.createDataFrame([(1, "0xb", 20), (1, "0xd", 3)], "chainid bigint, address string, creation_block bigint")
    plan = planning.fetch_plan(contracts, stored, latest, creations, ("logs",), 1000)
    got = rows(plan.select("address", "from_block", "to_block"))
    assert got == [("0xa", 150, 160), ("0xb", 20, 30), ("0xc", 0, 160), ("0xd", 7, 160)]


def test_retry_plan_sizes(spark):
    df = spark.createDataFrame([(50000, 0, 49999), (5000, 0, 2500)], "block_chunk_size bigint, from_block bigint, to_block bigint")
    got = planning.retry_plan(df).groupBy("retry_size").count()
    assert rows(got) == [(1000, 3), (5000, 10)]


@pytest.mark.parametrize("closest", ["before", "after"])
def test_blocks_at_against_brute_force(spark, closest):
    rng = random.Random(3)
    blocks, t = [], 0
    for number in range(400):
        t += rng.choice([0, 1, 12, 5000, 90000])
        blocks.append((number % 2, number, t))
    probes = [(rng.choice([0, 1, 2]), rng.randint(-1000, t + 1000)) for _ in range(500)]
    # One third of all probes ask for the same second.
    probes += [(0, blocks[100][2])] * 250
    b = spark.createDataFrame(blocks, "chainid bigint, block_number bigint, time_stamp bigint")
    p = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(probes)], "i int, chainid bigint, t bigint")

    def expected(chain, at):
        if closest == "before":
            known = [(s, n) for c, n, s in blocks if c == chain and s <= at]
            return max(known)[1] if known else None
        known = [(s, n) for c, n, s in blocks if c == chain and s >= at]
        return min(known)[1] if known else None

    for bucket in (86400, 3600):
        got = {r.i: r.block_number for r in block_time.blocks_at(p, b, closest, bucket).collect()}
        assert got == {i: expected(c, at) for i, (c, at) in enumerate(probes)}


def test_blocks_at_refuses_other_sides(spark):
    with pytest.raises(ValueError):
        block_time.blocks_at(None, None, "nearest")


def test_page_slice(spark):
    df = spark.range(25)
    assert [r.id for r in planning.page_slice(df, ["id"], 3, 10).collect()] == list(range(20, 25))


def test_not_null_counts_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    checks = quality.not_null(df, "t", ("a", "b"))
    assert plan_text(checks).count("Scan ExistingRDD") == 1
    assert rows(checks) == [("t", "a", 1, False), ("t", "b", 2, False)]


def test_declared_columns(spark):
    df = spark.createDataFrame([(1, "x", "y")], "chainid int, address string, extra string")
    got = {r.column: (r.declared, r.present) for r in quality.declared_columns(df, "decoded_logs").collect()}
    assert got["chainid"] == (True, True)
    assert got["event_name"] == (True, False)
    assert got["extra"] == (False, True)


def test_malformed(spark):
    df = spark.createDataFrame([('["a"]', "0xff"), ("nope", "0xfg"), (None, None), ("[]", "0x")], "topics string, data string")
    assert rows(quality.malformed_topics(df).select("topics")) == [("nope",)]
    assert rows(quality.malformed_words(df, "data").select("data")) == [("0xfg",)]


def sample_logs(spark, start, stop):
    return spark.range(start, stop).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(10).cast("bigint").alias("chainid"),
        F.concat(F.lit("0x"), F.col("id") % 5).alias("address"),
        (F.col("id") * 1000).alias("block_number"),
        F.concat(F.lit("0xt"), F.col("id")).alias("transaction_hash"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 4).alias("log_index"),
    )


def test_append_new_is_idempotent(spark):
    path = fresh_path(spark, "table")
    sort = ["address", "block_number"]
    assert writing.append_new(sample_logs(spark, 0, 500), path, sort) == 500
    assert writing.append_new(sample_logs(spark, 0, 500), path, sort) == 0
    overlapping = sample_logs(spark, 400, 600).unionByName(sample_logs(spark, 550, 600))
    assert writing.append_new(overlapping, path, sort) == 100
    stored = spark.read.parquet(path)
    columns = sample_logs(spark, 0, 1).columns
    assert rows(stored.select(columns)) == rows(sample_logs(spark, 0, 600))


def test_range_read_prunes_partitions_and_pushes_filters(spark):
    path = fresh_path(spark, "table")
    writing.append_new(sample_logs(spark, 0, 600), path, ["address", "block_number"])
    found = tables.read_range(spark.read.parquet(path), 200_000, 299_999, "0X3")
    plan = plan_text(found)
    assert "PartitionFilters: [isnotnull(block_bucket" in plan.replace("\n", "")
    assert "GreaterThanOrEqual(block_number,200000)" in plan and "In(address, [0X3,0x3])" in plan
    assert found.count() == 20


def test_touched_reads_only_overlapping_partitions(spark):
    path = fresh_path(spark, "table")
    writing.append_new(sample_logs(spark, 0, 600), path, ["address"])
    fetched = stage(sample_logs(spark, 0, 50).withColumn("block_bucket", tables.block_bucket(F.col("block_number"))), "f")
    part = writing.touched(spark.read.parquet(path), fetched)
    assert "PartitionFilters: []" not in plan_text(part)
    assert part.agg(F.max("block_number")).first()[0] < 100_000


def test_touched_reads_no_partition_between(spark):
    path = fresh_path(spark, "table")
    writing.append_new(sample_logs(spark, 0, 600), path, ["address"])
    ends = sample_logs(spark, 0, 600).where("block_number < 1000 or block_number > 550000")
    fetched = stage(ends.withColumn("block_bucket", tables.block_bucket(F.col("block_number"))), "f")
    part = writing.touched(spark.read.parquet(path), fetched)
    wanted = fetched.select("block_bucket").distinct().count()
    assert part.select("block_bucket").distinct().count() == wanted < spark.read.parquet(path).select("block_bucket").distinct().count()
    assert len({f.rsplit("/", 1)[0] for f in part.inputFiles()}) >= wanted


def test_unstage_deletes_the_copy(spark):
    copy = stage(sample_logs(spark, 0, 10), "copy")
    folder = copy.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.exists(folder)
    unstage(copy)
    assert not os.path.exists(folder)


def test_stored_table_before_first_write(spark):
    assert writing.stored_table(spark, fresh_path(spark, "none"), sample_logs(spark, 0, 1).schema) is None


def test_ledger_round_trip(spark):
    path = fresh_path(spark, "ledger")
    schema = "`table` string, contract_address string, chainid bigint, from_block bigint, to_block bigint, block_chunk_size bigint"
    failed = spark.createDataFrame([("logs", "0xa", 1, 0, 99, 50), ("logs", "0xb", 1, 0, 99, 50)], schema)
    writing.record_failures(failed, path)
    writing.resolve_failures(failed.where("contract_address = '0xa'"), path)
    still = writing.open_failures(spark.read.parquet(path))
    assert rows(still.select("contract_address", "block_chunk_size")) == [("0xb", 50)]
    writing.record_failures(failed.where("contract_address = '0xa'"), path)
    assert writing.open_failures(spark.read.parquet(path)).count() == 2


def test_table_helpers(spark):
    assert not tables.table_exists(spark, "nothing_here")
    assert tables.row_count(spark, "nothing_here") == 0
    spark.range(5).write.mode("overwrite").saveAsTable("five")
    assert tables.table_exists(spark, "five") and tables.row_count(spark, "five") == 5


def test_spread_leaves_wide_inputs_alone(spark):
    assert tables.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, 1, 64)
    assert tables.spread(wide) is wide


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# Sets of ranges.

def blocks_of(rows):
    out = {}
    for *key, low, high in rows:
        if low is not None and high is not None:
            out.setdefault(tuple(key), set()).update(range(low, high + 1))
    return {k: v for k, v in out.items() if v}


def as_ranges(spark, rows):
    return spark.createDataFrame(rows, "chainid long, contract string, from_block long, to_block long")


@pytest.mark.parametrize("span", [1, 7, 1_000_000])
def test_ranges_equal_sets_of_blocks(spark, span):
    rng = random.Random(span)

    def some(n):
        rows = [(rng.choice([1, 1, 1, None]), rng.choice(["a", None]), low := rng.randrange(60), low + rng.randrange(-2, 9)) for _ in range(n)]
        return [*rows, (1, "a", None, 4), (1, "b", 3, None)]

    keys, a, b = ["chainid", "contract"], some(40), some(25)
    left, right = as_ranges(spark, a), as_ranges(spark, b)
    got = [r[:] for r in ranges.merged(left, keys, span).collect()]
    assert blocks_of(got) == blocks_of(a)
    for x in got:
        assert not [y for y in got if y is not x and y[:2] == x[:2] and y[2] <= x[3] + 1 and x[2] <= y[3] + 1]
    monkey = blocks_of([r[:] for r in ranges.uncovered(left, right, keys).collect()])
    have, taken = blocks_of(a), blocks_of(b)
    assert monkey == {k: v - taken.get(k, set()) for k, v in have.items() if v - taken.get(k, set())}
    inside = sorted([r[:] for r in ranges.covered(left, right, keys).collect()], key=str)
    want = [x for x in a if x[2] is not None and x[3] is not None and x[2] <= x[3] and set(range(x[2], x[3] + 1)) <= taken.get(x[:2], set())]
    assert inside == sorted(want, key=str)


def test_ranges_of_nothing(spark):
    none, some = as_ranges(spark, []), as_ranges(spark, [(1, "a", 0, 9)])
    keys = ["chainid", "contract"]
    assert ranges.merged(none, keys).count() == ranges.covered(some, none, keys).count() == ranges.uncovered(none, some, keys).count() == 0
    assert [r[:] for r in ranges.uncovered(some, none, keys).collect()] == [(1, "a", 0, 9)]


def test_settling_takes_the_union_and_the_newest_entry(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [
        (0, 0, 99, "open"), (1, 0, 49, "whole"), (1, 50, 99, "whole"),
        (0, 200, 299, "open"), (1, 200, 250, "whole"), (1, 252, 299, "whole"),
        (0, 400, 499, "whole"), (1, 400, 499, "open"),
        (0, 600, 699, "open"), (1, 600, 699, "whole"),
    ]
    ledger = spark.createDataFrame([(at + datetime.timedelta(t), "logs", "0xa", 1, a, b, 100, s) for t, a, b, s in rows], "timestamp timestamp, table string, contract_address string, chainid long, from_block long, to_block long, block_chunk_size long, status string")
    assert [r.from_block for r in writing.settled_failures(ledger).collect()] == [0]
    assert sorted(r.from_block for r in writing.open_failures(ledger).collect()) == [0, 200, 400]
    assert sorted((r.from_block, r.to_block) for r in writing.whole_ranges(ledger).collect()) == [(0, 99), (200, 250), (252, 299), (600, 699)]


# Newest rows and packing.

def states(spark, rows):
    return spark.createDataFrame(rows, "chainid long, hash string, block_number long, confirmations long, value string")


def test_upsert_keeps_the_newest_row(spark):
    path, identity = fresh_path(spark, "newest"), (["chainid", "hash"], ["confirmations"])
    put = lambda *rows: writing.upsert(states(spark, list(rows)), path, ["block_number"], identity)
    kept = lambda: sorted((r.hash, r.confirmations, r.value) for r in spark.read.parquet(path).collect())
    assert put((1, "a", 5, 1, "x"), (1, "b", 150_000, 1, "x"), (1, "a", 5, 2, "y")) == 2
    assert kept() == [("a", 2, "y"), ("b", 1, "x")]
    others = lambda: {f for f in spark.read.parquet(path).inputFiles() if "block_bucket=1/" in f}
    files = others()
    assert put((1, "a", 5, 1, "old"), (1, "a", 5, 7, "new"), (1, "c", 6, None, "c")) == 1
    assert kept() == [("a", 7, "new"), ("b", 1, "x"), ("c", None, "c")]
    # The other partition is still the same file; a refetch without news writes nothing.
    assert others() == files
    before = set(spark.read.parquet(path).inputFiles())
    assert put((1, "a", 5, 7, "else"), (1, "c", 6, None, "c")) == 0
    assert before <= set(spark.read.parquet(path).inputFiles()) and kept() == [("a", 7, "new"), ("b", 1, "x"), ("c", None, "c")]
    assert put((1, "c", 6, 1, "d"), (None, "n", None, 3, "n")) == 1
    assert put((None, "n", None, 4, "m")) == 0
    assert kept() == [("a", 7, "new"), ("b", 1, "x"), ("c", 1, "d"), ("n", 4, "m")]
    # Mined again in another block: the row moves.
    assert put((1, "b", 3, 9, "moved"), (1, "e", 150_001, 1, "e")) == 1
    assert kept() == [("a", 7, "new"), ("b", 9, "moved"), ("c", 1, "d"), ("e", 1, "e"), ("n", 4, "m")]


def test_a_replacement_that_was_lost_is_completed(spark, monkeypatch):
    path, identity = fresh_path(spark, "newest"), (["chainid", "hash"], ["confirmations"])
    writing.upsert(states(spark, [(1, "a", 5, 1, "x"), (1, "b", 6, 1, "x")]), path, ["block_number"], identity)

    def lost(spark, path):
        if writing.stored_table(spark, f"{path}_replacing", None) is not None:
            raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(writing, "finish_replacing", lost)
        with pytest.raises(RuntimeError):
            writing.upsert(states(spark, [(1, "a", 5, 2, "y")]), path, ["block_number"], identity)
    # Between stage and swap nothing is lost, and the next job completes it.
    assert spark.read.parquet(path).count() == 2
    assert writing.finish_replacing(spark, path) and not writing.finish_replacing(spark, path)
    assert sorted((r.hash, r.confirmations) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1)]


def test_fifty_appends_are_packed(spark):
    path = fresh_path(spark, "packed")
    rows = spark.range(2000).select(F.lit(1).cast("long").alias("chainid"), F.concat(F.lit("0x"), F.col("id") % 7).alias("address"), (F.col("id") * 100).alias("block_number"))
    for n in range(50):
        part = rows.where(F.col("block_number") / 100 % 50 == n).withColumn("block_bucket", F.floor(F.col("block_number") / 100_000))
        part.coalesce(1).write.mode("append").partitionBy("chainid", "block_bucket").parquet(path)
    assert writing.partition_files(spark, path).agg(F.min("files")).first()[0] == 50
    assert writing.compact(spark, path, ["address", "block_number"], partitions=[(1, 0)]) == 1
    assert writing.compact(spark, path, ["address", "block_number"]) == 1
    assert writing.partition_files(spark, path).agg(F.max("files")).first()[0] <= 2
    stored = spark.read.parquet(path).select(rows.columns)
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 2000
    assert writing.compact(spark, path, ["address", "block_number"]) == 0


def test_extents_come_from_footers(spark):
    path = fresh_path(spark, "extent")
    writing.append_new(sample_logs(spark, 0, 300), path, ["address"])
    writing.append_new(sample_logs(spark, 300, 400), path, ["address"])
    got = rows(tables.stored_extent(spark, path).select("rows", "first_block", "last_block"))
    assert got == rows(tables.extent_of(spark.read.parquet(path)).select("rows", "first_block", "last_block"))
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = tables.extent_of(own.read.parquet(path))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedAggregation: [COUNT(*), MIN(block_number), MAX(block_number)]" in plan


def test_null_newest_gives_way_and_stays_if_equal(spark):
    path = fresh_path(spark, "table")
    schema = "chainid long, hash string, block_number long, confirmations long"
    fetch = lambda *rows: spark.createDataFrame([(1, h, 5, n) for h, n in rows], schema)
    identity = (["chainid", "hash"], ["confirmations"])
    assert writing.upsert(fetch(("0xa", None), ("0xa", None), ("0xb", 3), (None, 1)), path, ["block_number"], identity) == 3
    assert writing.upsert(fetch(("0xa", 1), ("0xb", None), (None, 2), ("0xc", None)), path, ["block_number"], identity) == 1
    found = {(r["hash"], r["confirmations"]) for r in spark.read.parquet(path).collect()}
    assert found == {("0xa", 1), ("0xb", 3), (None, 2), ("0xc", None)}
