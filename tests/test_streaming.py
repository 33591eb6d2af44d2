"""The stream gives what the batch gives, in any order, and resumes from its checkpoint."""

from pyspark.sql import functions as F

from blockloom.operators import writing
from blockloom.plans import backfill, models
from blockloom.session import fresh_path
from blockloom.sources import landing
from blockloom.streaming import ingest
from workload import fixtures


def test_stream_equals_batch_and_resumes(spark, sf_dir):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "checkpoint"))
    pages = fixtures.log_pages(spark, sf_dir, rejects=False)

    def run():
        rows = landing.to_table_names(landing.logs_from_pages(landing.stream_pages(spark, folder)))
        ingest.append_available(rows, out, checkpoint, ["address"], each=models.decoded_logs)
        return spark.read.parquet(out)

    pages.write.json(folder)
    batch = models.decoded_logs(landing.to_table_names(landing.logs_from_pages(pages)))
    first = run()
    assert first.count() == batch.count()
    assert first.select(batch.columns).exceptAll(batch).count() == 0
    assert run().count() == batch.count()
    # The same pages land again: nothing new comes out.
    pages.write.mode("append").json(folder)
    assert run().count() == batch.count()


def test_old_blocks_in_later_triggers_are_not_lost(spark):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "checkpoint"))
    for block in (100_000_000, 1, 2, 1):
        row = '[{"blockNumber":"%d","transactionHash":"0x%d","logIndex":"0x0","topics":["0xt"],"timeStamp":"%d"}]' % (block, block, block)
        page = spark.createDataFrame([("1", "OK", row, "0xa", "ethereum", 0, 9, 1)], "status string, message string, result string, address string, chain string, from_block long, to_block long, page long")
        page.coalesce(1).write.mode("append").json(folder)
    rows = landing.warehouse_logs(landing.logs_from_pages(landing.stream_pages(spark, folder, files_per_trigger=1)))
    ingest.append_available(rows, out, checkpoint, ["address"])
    assert sorted(r.block_number for r in spark.read.parquet(out).collect()) == [1, 2, 100_000_000]


def test_rejects_of_a_stream_are_ledgered_like_those_of_a_load(spark, sf_dir):
    folder, out, ledger, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "ledger", "checkpoint"))
    fixtures.odd_log_pages(spark, sf_dir).unionByName(fixtures.broken_page(spark, sf_dir)).repartition(3).write.json(folder)
    batch_out, batch_ledger = fresh_path(spark, "out"), fresh_path(spark, "ledger")
    batch = backfill.load_landing(spark, folder, batch_out, batch_ledger, page_rows=1001)
    loads = []
    pages = landing.stream_pages(spark, folder, files_per_trigger=1)
    ingest.load_available(pages, out, ledger, checkpoint, page_rows=1001, done=loads.append)
    assert len(loads) > 1 and sum(x.rows_added for x in loads) == batch.rows_added
    opened = lambda path: writing.open_failures(spark.read.parquet(path))
    assert opened(ledger).exceptAll(opened(batch_ledger)).isEmpty() and opened(ledger).count() == opened(batch_ledger).count() > 0
    assert spark.read.parquet(out).exceptAll(spark.read.parquet(batch_out)).isEmpty()


def test_a_batch_that_runs_again_changes_nothing(spark, sf_dir):
    folder, out, ledger = (fresh_path(spark, n) for n in ("landing", "out", "ledger"))
    fixtures.odd_log_pages(spark, sf_dir).write.json(folder)
    for checkpoint in (fresh_path(spark, "checkpoint"), fresh_path(spark, "checkpoint")):
        ingest.load_available(landing.stream_pages(spark, folder), out, ledger, checkpoint, page_rows=1001)
        rows, failures = spark.read.parquet(out).count(), writing.open_failures(spark.read.parquet(ledger)).count()
        told = []
        ingest.load_available(landing.stream_pages(spark, folder), out, ledger, checkpoint, page_rows=1001, done=told.append)
        assert not told and (rows, failures) == (spark.read.parquet(out).count(), writing.open_failures(spark.read.parquet(ledger)).count())


def test_rows_beyond_what_is_stored_need_no_look_at_the_table(spark, monkeypatch):
    path = fresh_path(spark, "table")
    rows = lambda a, b: spark.range(a, b).select(F.lit(1).cast("long").alias("chainid"), F.lit("0xa").alias("address"), F.col("id").alias("block_number"))
    looked = []
    plain = writing.in_partitions
    monkeypatch.setattr(writing, "in_partitions", lambda table, some: looked.append(list(some)) or plain(table, some))
    for a, b, new in ((0, 100, 100), (100, 200, 100), (200, 200, 0), (150, 250, 50), (250, 260, 10), (0, 5, 0)):
        assert writing.append_new(rows(a, b), path, ["block_number"]) == new
    # Only the two fetches that reach back were compared with a partition.
    assert [bool(x) for x in looked] == [False, True, False, True]
    assert spark.read.parquet(path).count() == 260


def test_state_lets_no_row_through_twice_and_loses_none(spark):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "checkpoint"))
    schema = "chainid long, address string, block_number long, transaction_hash string, log_index long, data string"
    for blocks in ([5, 6], [5, 6, 7], [1, 2, 7], [2, 3, 1_000_000]):
        rows = [(1, "0xa", b, f"0x{b}", 0, "x") for b in blocks]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    seen = []
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest.append_available(rows, out, checkpoint, ["address"], each=lambda df: seen.append(df.count()) or df)
    assert sorted(r.block_number for r in spark.read.parquet(out).collect()) == [1, 2, 3, 5, 6, 7, 1_000_000]
    assert sorted(n for n in seen if n) == [1, 2, 2, 2]


def test_appends_of_a_stream_plan_by_size_and_leave_the_session_as_it_was(spark, monkeypatch):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "checkpoint"))
    schema = "chainid long, address string, block_number long"
    spark.createDataFrame([(1, "0xa", 5), (1, "0xa", 5), (1, "0xa", 6)], schema).write.parquet(folder)
    adaptive, plain = [], ingest.append_new
    look = lambda df, *args, **named: adaptive.append(df.sparkSession.conf.get("spark.sql.adaptive.enabled")) or plain(df, *args, **named)
    monkeypatch.setattr(ingest, "append_new", look)
    stores = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    mine = {"spark.sql.shuffle.partitions": "100", stores: "false"}
    before = {name: spark.conf.get(name) for name in mine}
    try:
        for name, value in mine.items():
            spark.conf.set(name, value)
        ingest.append_available(spark.readStream.schema(schema).parquet(folder), out, checkpoint, ["address"])
        assert {name: spark.conf.get(name) for name in mine} == mine
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert set(adaptive) == {"true"}
    assert sorted(r.block_number for r in spark.read.parquet(out).collect()) == [5, 6]
    # No more state stores than two a core, or 32.
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/state/0")
    kept = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert len([s for s in kept if s.getPath().getName().isdigit()]) == 32


def test_the_state_of_a_stream_has_a_bounded_share_of_memory_in_any_session(spark):
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "checkpoint"))
    schema = "chainid long, address string, block_number long"
    spark.createDataFrame([(1, "0xa", 5), (1, "0xa", 5)], schema).write.parquet(folder)
    rocks, seen = "spark.sql.streaming.stateStore.rocksdb.", []
    before = spark.conf.get(f"{rocks}boundedMemoryUsage")
    look = lambda df: seen.append([df.sparkSession.conf.get(rocks + n) for n in ("boundedMemoryUsage", "maxMemoryUsageMB")]) or df
    try:
        spark.conf.set(f"{rocks}boundedMemoryUsage", "false")
        ingest.append_available(spark.readStream.schema(schema).parquet(folder), out, checkpoint, ["address"], each=look)
    finally:
        spark.conf.set(f"{rocks}boundedMemoryUsage", before)
    assert seen == [["true", "256"]]
    assert spark.read.parquet(out).count() == 1
