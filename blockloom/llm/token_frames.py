"""Token ids in files of independent zstandard frames.

A file holds one frame per document, its ids as little-endian unsigned 32-bit
integers, then a directory frame with the documents' ids, and a trailing seek
table: a skippable frame with each frame's compressed and plain size and the
low 32 bits of its XXH64, in the layout of the zstandard seekable format. A
reader takes the table from the end of the file and decompresses the frames
of the documents it wants, checking each; any zstandard tool can read the
whole file.

Documents lie in ascending doc_id order over the files and inside them.
Frames are made where the texts are, so that only compressed ids move.

Nulls and ties: a null text counts as empty and is the end id alone. Null
doc_ids come last. Equal doc_ids lie beside each other, ordered by their
frames. An empty table gives no file and no row; columns beside doc_id and
text are not looked at.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path, qualified, stage
from .common import kept, table

END_ID = 2
LEVEL = 3
#: Words whose ids a worker keeps at a time.
REMEMBERED = 800_000
#: Signs that begin a word of their own after a letter or digit; an apostrophe may not, and ``<`` may begin a special token.
SIGNS = "".join(c for c in string.punctuation if c not in "'<")
#: Letters whose words the model is given directly: those of ASCII and Latin-1.
LETTERS = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if chr(c).isalpha())
# Fixed values of the zstandard seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = "<III", "<IBI"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """The ids of words, found by the tokenizers library when first asked for.

    This tokenizer parts words at white space and before a sign that follows
    a letter or digit, and reads capitals as small letters; a word that
    differs from another in that alone is looked up by it. Of letters alone
    it makes one word, which its model takes as it is, letters beyond ASCII
    spelled the way the library spells them.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = lambda c: "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(c)))
        self.spelled = {ord(c): spell(c) for c in LETTERS}
        self.only_letters = re.compile(f"[{LETTERS}]+").fullmatch

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            # The half that was met first goes; frequent words come back at once.
            for old in list(itertools.islice(self, REMEMBERED // 2)):
                del self[old]
        found = self[word] = self._found(word)
        return found

    def _found(self, word: str) -> bytes:
        if self.only_letters(word):
            return array("I", [t.id for t in self.model.tokenize(word.translate(self.spelled))]).tobytes()
        if "<" not in word:  # else it may hold a special token
            base = word.rstrip(SIGNS)
            if base != word and base and base[-1].lower().isalnum():
                return self[base] + self[word[len(base) :]]
            if word.isascii() and word != word.lower():
                return self[word.lower()]
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """White space parts this tokenizer's words and leaves no id, so a
        text's ids are those of what stands between blanks and line feeds."""
        return [b"".join(map(self.__getitem__, (t or "").replace("\n", " ").split(" "))) for t in texts]


def words(path: str) -> _Words:
    """The tokenizer, loaded once in each worker."""
    return kept(("words", path), lambda: _Words(path))


def frame(plain: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress(plain)


def checksum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


def open_folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI or a local path, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(path)


@dataclass
class Writer:
    """Appends frames to a stream, then the directory and the seek table."""

    out: object

    def __post_init__(self) -> None:
        self.entries: list[bytes] = []
        self.docs: list[int | None] = []

    def add(self, doc_id: int | None, packed: bytes, size: int, check: int) -> None:
        self.out.write(packed)
        self.entries.append(struct.pack(ENTRY, len(packed), size, check))
        self.docs.append(doc_id)

    def close(self) -> None:
        ids = np.array([0 if d is None else d for d in self.docs], dtype="<i8").tobytes()
        known = np.array([d is not None for d in self.docs], dtype="u1").tobytes()
        plain = ids + known
        packed = frame(plain)
        self.out.write(packed)
        entries = [*self.entries, struct.pack(ENTRY, len(packed), len(plain), checksum(plain))]
        table_bytes = b"".join(entries) + struct.pack(FOOTER, len(entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table_bytes)) + table_bytes)


class Reader:
    """A file's documents by place, each read and checked on its own."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - struct.calcsize(FOOTER))
        count, flags, magic = struct.unpack(FOOTER, source.read(struct.calcsize(FOOTER)))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        length = count * struct.calcsize(ENTRY) + struct.calcsize(FOOTER)
        source.seek(size - length - 8)
        if struct.unpack("<II", source.read(8)) != (SKIPPABLE, length):
            raise ValueError("the seek table does not have the size it states")
        entries = np.frombuffer(source.read(count * struct.calcsize(ENTRY)), dtype="<u4").reshape(count, 3)
        self.packed, self.plain, self.check = (entries[:, i].astype(np.int64) for i in range(3))
        self.start = np.concatenate([[0], np.cumsum(self.packed)])
        directory = self.read(count - 1)
        n = count - 1
        ids, known = np.frombuffer(directory[: 8 * n], dtype="<i8"), np.frombuffer(directory[8 * n :], dtype="u1")
        self.docs = [int(d) if k else None for d, k in zip(ids, known)]

    def read(self, place: int) -> bytes:
        self.source.seek(int(self.start[place]))
        packed = self.source.read(int(self.packed[place]))
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.plain[place]))
        if len(plain) != self.plain[place] or checksum(plain) != self.check[place]:
            raise ValueError(f"frame {place} is damaged")
        return plain

    def ids(self, place: int) -> np.ndarray:
        return np.frombuffer(self.read(place), dtype="<u4")


def _frames(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, frame, size, sum) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = words(path), np.array([END_ID], dtype="<u4").tobytes()
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                plain = [p + end for p in known.ids(batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([frame(p) for p in plain], type=pa.binary()),
                        pa.array([len(p) for p in plain], type=pa.int64()),
                        pa.array([checksum(p) for p in plain], type=pa.int64()),
                    ],
                    names=["doc_id", "frame", "size", "sum"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, frame binary, size long, sum long")


def write(docs: DataFrame, folder: str, files: int | None = None, path: str | None = None) -> DataFrame:
    """Writes the files and returns (file, path, docs, ids), one row per file in order.

    Files are cut at quantiles of doc_id, so no task gathers more than its
    share. A task writes under a name of its own and renames at the end: a
    task that runs again replaces its file by an equal one.
    """
    spark = docs.sparkSession
    path, folder = path or model_path(), qualified(docs.sparkSession, folder)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.col("doc_id").cast("long")).approxQuantile("doc_id", [i / files for i in range(1, files)], 0.1 / files) if files > 1 else []
    cuts = sorted({int(c) for c in cuts})
    place = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(_place(F.col("doc_id"), cuts, 0, len(cuts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        writer, number, ids = None, TaskContext.get().partitionId(), 0
        final = f"{base}/tokens-{number:06d}.zst"
        own = f"{base}/.tokens-{number:06d}-{TaskContext.get().taskAttemptId()}"
        stream = None
        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    stream = fs.open_output_stream(own, compression=None)
                    writer = Writer(stream)
                writer.add(row["doc_id"], row["frame"], row["size"], row["sum"])
                ids += row["size"] // 4
        if writer is not None:
            writer.close()
            stream.close()
            fs.move(own, final)
            yield pa.RecordBatch.from_pydict(
                {"file": pa.array([number], pa.int32()), "path": [final], "docs": pa.array([len(writer.docs)], pa.int64()), "ids": pa.array([ids], pa.int64())}
            )

    made = _frames(docs, path).withColumn("_place", place.cast("int"))
    made = made.repartitionById(len(cuts) + 1, F.col("_place"))
    made = made.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "size", "sum", "frame").drop("_place")
    return stage(made.mapInArrow(run, "file int, path string, docs long, ids long"), "token-files")


def _place(doc_id, cuts: list[int], low: int, high: int):
    """How many of the cuts are at or below the id, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(doc_id < cuts[middle], _place(doc_id, cuts, low, middle)).otherwise(_place(doc_id, cuts, middle + 1, high))


def read(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents in ``files``, one task a file."""
    folder = qualified(files.sparkSession, folder)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    n = max(files.count(), 1)
    files = files.select(F.row_number().over(Window.orderBy("file")).alias("_n"), "path", "_before")
    files = files.repartitionById(n, F.col("_n") - 1).select("path", "_before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["path"]) as source:
                    reader, start = Reader(source), row["_before"]
                    for low in range(0, len(reader.docs), 1000):
                        docs = reader.docs[low : low + 1000]
                        plain = [reader.read(low + i) for i in range(len(docs))]
                        n_tokens = np.array([len(p) // 4 for p in plain], dtype=np.int64)
                        starts = start + np.concatenate([[0], np.cumsum(n_tokens)[:-1]])
                        start += int(n_tokens.sum())
                        crc = pa.array([zlib.crc32(p) for p in plain], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, pa.int64()), pa.array(starts.astype(np.int64)), pa.array(n_tokens), crc],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    return read(write(table(spark, sf_dir, "documents"), folder), folder)
