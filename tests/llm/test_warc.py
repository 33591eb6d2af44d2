from __future__ import annotations

import gzip
import random

import pyarrow as pa
from compare import difference, duck

from blockloom.llm import warc as W
from blockloom.llm.queries import ORACLES, QUERIES


def walk(data):
    records, gaps = [], []
    for x in W.Salvage(pa.BufferReader(bytes(data))).walk():
        (gaps if isinstance(x, tuple) else records).append(x)
    return records, gaps


def archive(n, packed=True):
    plain = [W.record(i, f"http://a/{i}", f"<p>page {i}</p>" * (i % 9 * 40), None if i % 4 else 0) for i in range(n)]
    return [W.member(p) if packed else p for p in plain]


def test_whole_archives():
    for packed in (True, False):
        parts = archive(30, packed)
        records, gaps = walk(b"".join(parts))
        assert [r.headers["page-id"] for r in records] == [str(i) for i in range(30)] and not gaps
    assert gzip.decompress(archive(3)[1]).startswith(b"WARC/1.1\r\n")


def test_one_damaged_record_costs_one_record():
    for packed in (True, False):
        parts = archive(30, packed)
        for hurt in (0, 11, 29):
            data = [bytearray(p) for p in parts]
            data[hurt][len(data[hurt]) // 2] ^= 0x55
            start = sum(map(len, parts[:hurt]))
            records, gaps = walk(b"".join(data))
            assert [r.headers["page-id"] for r in records] == [str(i) for i in range(30) if i != hurt]
            assert [(g[0], g[1]) for g in gaps] == [(start, start + len(parts[hurt]))] and gaps[0][2]


def test_garbage_lost_bytes_and_cut_ends():
    rng, parts = random.Random(2), archive(12)
    noise = bytes(rng.randrange(256) for _ in range(100_000)) + W.MEMBER + b"no member" + W.VERSION + b"0\r\nno record"
    records, gaps = walk(noise + b"".join(parts[:5]) + noise + b"".join(parts[5:])[:-7])
    assert [r.headers["page-id"] for r in records] == [str(i) for i in range(11)]
    assert len(gaps) == 3 and sum(g[1] - g[0] for g in gaps) == 2 * len(noise) + len(parts[11]) - 7
    records, gaps = walk(parts[0][:-5] + b"".join(archive(4, packed=False)[1:]) + parts[4])
    assert [r.headers["page-id"] for r in records] == ["1", "2", "3", "4"] and len(gaps) == 1
    assert walk(b"") == ([], [])


def test_damaged_archives_in_spark(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 50) for i in range(40)], "page_id long, url string, html string")
    files = W.write(pages.coalesce(1), str(tmp_path)).collect()
    data = bytearray(open(files[0].path, "rb").read())
    hurt = W.read(spark.createDataFrame(files), str(tmp_path)).collect()[20]
    data[(hurt.start + hurt.end) // 2] ^= 0xFF
    open(files[0].path, "wb").write(data)
    rows = W.read(spark.createDataFrame(files), str(tmp_path)).collect()
    assert [r.kind for r in rows].count("record") == 39 and [r.kind for r in rows].count("gap") == 1
    assert all(bytes(r.payload) == b"<p>%d</p>" % int(r.headers["page-id"]) * 50 for r in rows if r.kind == "record")


def test_awkward_pages(spark, tmp_path):
    rows = [(1, "u", "a"), (2, None, "a"), (3, "u\n x", None), (4, "u", ""), (5, "u", "é" * 9), (5, "u", "é" * 9), (None, "u", "a"), (None, "u", "b"), (6, "u", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, first int, key string")
    got = W.read(W.write(pages, str(tmp_path), file_bytes=100), str(tmp_path))
    out = {(r.headers.get("page-id"), r.payload_bytes, r.headers["warc-type"], r.headers.get("refers-to-page-id")) for r in got.collect()}
    assert got.count() == len(rows)
    assert out == {
        ("1", 1, "response", None), ("2", 1, "revisit", "1"), ("3", 0, "response", None), ("4", 0, "revisit", "3"), ("5", 18, "response", None),
        (None, 1, "revisit", "1"), (None, 1, "response", None), ("6", 300_000, "response", None),
    }
    assert W.read(W.write(pages.where("false"), str(tmp_path / "none")), str(tmp_path / "none")).count() == 0


def test_long_urls(spark, tmp_path):
    url = "data:text/html," + "a\n" * 50_000
    for packed in (True, False):
        parts = [W.record(i, url, "<p>page</p>", None if i % 2 else 1) for i in range(4)]
        records, gaps = walk(b"".join(W.member(p) if packed else p for p in parts))
        assert [r.headers["page-id"] for r in records] == ["0", "1", "2", "3"] and not gaps
        assert all(r.headers["warc-target-uri"] == url.replace("\n", "%0A") for r in records)
    parts[1] = bytearray(parts[1])
    parts[1][90_000:90_004] = b"\xff\xff\xff\xff"
    records, gaps = walk(b"".join(parts))
    assert [r.headers["page-id"] for r in records] == ["0", "2", "3"] and len(gaps) == 1
    pages = spark.createDataFrame([(1, url, "a"), (2, "u", "a")], "page_id long, url string, html string")
    got = W.read(W.write(pages, str(tmp_path)), str(tmp_path)).where("kind = 'record'").collect()
    assert {(r.headers["page-id"], r.headers.get("refers-to-page-id")) for r in got} == {("1", None), ("2", "1")}


def test_oracle(spark, sf_dir):
    assert difference(spark, duck(sf_dir), QUERIES["op4_warc"], ORACLES["op4_warc"], sf_dir) is None
