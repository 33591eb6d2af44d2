"""WARC archives, and a reader that salvages what damage leaves.

Each page is a record in a gzip member of its own: a response with the page
as payload, or, if the payload was seen before, a revisit that refers to it.
The reader checks each record: the member's checksum, the version line, the
stated length, the end marks and the block digest. After a failed check it
searches for the next member or version line that starts a valid record, goes
on from there, and logs the bytes between as a quarantined gap. Later records
are recovered whatever came before them.

A header may have any length, and so may the url in it.

Nulls and ties: a null html is an empty payload. Equal payloads, empty ones
too, refer to the record with the smallest page_id; rows that repeat both
page_id and payload as the smallest are responses each. A null page_id is
larger than any other. A null url has no target line. An empty table gives no
archive and no row; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path, qualified, stage
from .common import table
from .token_frames import open_folder

#: Payloads of fewer bytes are never revisited.
LEAST_REVISIT = 0
#: An archive is closed after so many bytes.
FILE_BYTES = 64 << 20
CHUNK = 1 << 16
#: Date of all records, unless a caller gives another: reruns write equal archives.
DATE = "2024-01-01T00:00:00Z"
MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    key = F.sha2(F.col("html").cast("binary"), 256)
    sized = pages.select("page_id", F.coalesce(F.col("html"), F.lit("")).alias("html")).select("page_id", key.alias("key"), F.octet_length("html").alias("size"))
    first = sized.where(F.col("size") >= least).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    # Only payloads that occur twice have anything to say.
    again = stage(first.where("rows > 1").select("key", "first"), "payloads")
    out = rows.withColumn("key", key).join(again, "key", "left")
    own = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "html", F.when(~own, F.col("first")).alias("refers_to"))


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}')}>"


def record(page_id: int | None, url: str | None, html: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, not compressed."""
    payload = html.encode()
    name = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, name)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{name}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, name)}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(plain: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes the archives and returns (path, records, bytes), one row each.
    A task that runs again writes new files; the returned rows name those that count."""
    folder = qualified(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        task, number, stream, done = TaskContext.get(), 0, None, []

        def close() -> None:
            stream.close()
            done.append((path, records, size))

        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                for row in whole.slice(start, 200).to_pylist():
                    if stream is None:
                        path = f"{base}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                        stream, records, size, number = fs.open_output_stream(path, compression=None), 0, 0, number + 1
                    packed = member(record(**row))
                    stream.write(packed)
                    records, size = records + 1, size + len(packed)
                    if size >= file_bytes:
                        close()
                        stream = None
        if stream is not None:
            close()
        if done:
            path, records, size = map(list, zip(*done))
            yield pa.RecordBatch.from_pydict({"path": path, "records": pa.array(records, pa.int64()), "bytes": pa.array(size, pa.int64())})

    return stage(planned(pages, least).mapInArrow(run, "path string, records long, bytes long"), "archives")


@dataclass
class Found:
    """A record and the bytes of the file that hold it."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes


class Damage(Exception):
    pass


class Salvage:
    """Walks an archive, compressed or not or both, past damaged bytes."""

    def __init__(self, source) -> None:
        self.source, self.size = source, source.size()

    def bytes_at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(max(min(n, self.size - at), 0))

    def next_start(self, at: int) -> int | None:
        """The next place, from ``at`` on, where a member or version line may start."""
        keep = max(len(MEMBER), len(VERSION)) - 1
        while at < self.size:
            data = self.bytes_at(at, CHUNK + keep)
            places = [p for p in (data.find(MEMBER), data.find(VERSION)) if 0 <= p < CHUNK]
            if places:
                return at + min(places)
            at += CHUNK
        return None

    @staticmethod
    def split_header(data: bytes) -> tuple[dict[str, str], int]:
        if not data.startswith(VERSION):
            raise Damage("no version line")
        end = data.find(b"\r\n\r\n")
        if end < 0:
            raise Damage("header does not end")
        try:
            lines = data[:end].decode().split("\r\n")[1:]
        except UnicodeDecodeError:
            raise Damage("header is no text") from None
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not headers.get("content-length", "").isdigit() or not headers.get("warc-type"):
            raise Damage("header states no length or no type")
        return headers, end + 4

    @staticmethod
    def checked(headers: dict[str, str], block: bytes, ending: bytes) -> bytes:
        if len(block) != int(headers["content-length"]) or ending != b"\r\n\r\n":
            raise Damage("record does not have the length it states")
        stated = headers.get("warc-block-digest", "")
        if stated.startswith("sha1:") and stated[5:] != digest(block):
            raise Damage("block digest differs")
        return block

    def member_at(self, at: int) -> Found:
        unpacker, plain, fed = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            data = self.bytes_at(fed, CHUNK)
            if not data:
                raise Damage("member is cut off")
            fed += len(data)
            try:
                plain.append(unpacker.decompress(data))
            except zlib.error:
                raise Damage("member is damaged") from None
            if len(plain) == 1 and plain[0] and not plain[0].startswith(VERSION[: len(plain[0])]):
                raise Damage("no version line")
        data = b"".join(plain)
        headers, body = self.split_header(data)
        block = self.checked(headers, data[body:-4], data[-4:])
        return Found(at, fed - len(unpacker.unused_data), headers, block)

    def header_at(self, at: int) -> bytes:
        """A plain record's header up to its end, however long; only the bytes
        searched last are held until the end is found."""
        low = at
        while low < self.size:
            data = self.bytes_at(low, CHUNK + 3)
            end = data.find(b"\r\n\r\n")
            if end >= 0:
                return self.bytes_at(at, low + end + 4 - at)
            low += CHUNK
        raise Damage("header does not end")

    def plain_at(self, at: int) -> Found:
        headers, body = self.split_header(self.header_at(at))
        length = int(headers["content-length"])
        if at + body + length + 4 > self.size:
            raise Damage("record is cut off")
        data = self.bytes_at(at + body, length + 4)
        return Found(at, at + body + length + 4, headers, self.checked(headers, data[:-4], data[-4:]))

    def record_at(self, at: int) -> Found:
        head = self.bytes_at(at, len(VERSION))
        if head.startswith(MEMBER):
            return self.member_at(at)
        if head == VERSION:
            return self.plain_at(at)
        raise Damage("neither a member nor a version line")

    def walk(self) -> Iterator[Found | tuple[int, int, str]]:
        """Records, and the gaps between them as (start, end, reason)."""
        at = 0
        while at < self.size:
            try:
                found = self.record_at(at)
            except Damage as damage:
                gap, reason, found = at, str(damage), None
                at = self.next_start(at + 1)
                while at is not None:
                    try:
                        found = self.record_at(at)
                        break
                    except Damage:
                        at = self.next_start(at + 1)
                yield gap, self.size if found is None else at, reason
                if found is None:
                    return
            yield found
            at = found.end


def read(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records and gaps of the archives named by ``path``, one task a file.

    kind is record or gap; path, start and end say where it lies. Records have
    headers, payload (null for revisits), payload_bytes and payload_digest;
    gaps have a reason.
    """
    folder = qualified(archives.sparkSession, folder)
    n = max(archives.count(), 1)
    files = archives.select("path", F.row_number().over(Window.orderBy("path")).alias("_n"))
    files = files.repartitionById(n, F.col("_n") - 1).select("path")
    names = ["kind", "path", "start", "end", "headers", "payload", "payload_bytes", "payload_digest", "reason"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def rows(path: str, source) -> Iterator[tuple]:
        for x in Salvage(source).walk():
            if isinstance(x, tuple):
                yield "gap", path, x[0], x[1], None, None, None, None, x[2]
                continue
            http, _, payload = x.block.partition(b"\r\n\r\n")
            if x.headers["warc-type"] == "revisit":
                length = re.search(rb"(?im)^content-length: *(\d+)", http)
                size, name, payload = int(length[1]) if length else None, x.headers.get("warc-payload-digest", "")[5:], None
            else:
                size, name = len(payload), digest(payload)
            yield "record", path, x.start, x.end, list(x.headers.items()), payload if with_payload else None, size, name, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_file(path) as source:
                    held, size = [], 0
                    for row in rows(path, source):
                        held.append(row)
                        size += 1000 + len(row[5] or b"")
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    schema = "kind string, path string, start long, end long, headers map<string,string>, payload binary, payload_bytes long, payload_digest string, reason string"
    return files.mapInArrow(run, schema)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    found = read(write(table(spark, sf_dir, "pages"), folder), folder, with_payload=False)
    # These archives were written just now: a gap in one is a fault, not a record less.
    gap = F.raise_error(F.concat(F.lit("a gap in "), "path", F.lit(" at "), F.col("start").cast("string"), F.lit(": "), F.coalesce("reason", F.lit(""))))
    found = found.where(F.when(F.col("kind") == "record", F.lit(True)).otherwise(gap.cast("boolean")))
    header = F.col("headers")
    return found.select(
        header["page-id"].cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        header["warc-type"].alias("record_type"),
        header["refers-to-page-id"].cast("long").alias("refers_to"),
    )


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP4_SQL = f"""
with p as (
  select page_id, coalesce(html, '') as html from pages),
g as (
  select *, min(page_id) over (partition by html) as first, sha1(html) as hex from p)
select page_id, octet_length(encode(html)) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}', 1 + cast(
    (cast('0x' || substr(hex, 1 + 5 * cast(floor(i / 4) as integer), 5) as integer) >> (15 - 5 * (i % 4)))::integer & 31 as integer), 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from g
"""
