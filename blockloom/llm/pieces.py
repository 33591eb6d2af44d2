"""SentencePiece encoding and decoding with a table of last tokens.

For a merge-type (BPE) model the encoding of every prefix of a text ends in
one token and no other. Walking the matches of an automaton over all pieces,
a piece that ends at a prefix is that token if the encoding of what stands
before it ends in a token that stays apart from it, that is, if the two
pieces put together would not have merged otherwise. The table of last tokens
is filled once from left to right and the ids are read from it backwards.

No piece has a blank after another letter, so a text falls apart before each
run of blanks; equal parts, and most words occur often, are encoded once.

A null text is an empty one: no ids, and it decodes to an empty text.
Characters without a piece become their UTF-8 bytes. Nulls in other columns,
repeated rows and extra columns pass through; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import kept, table

BLANK = "▁"
#: Words whose ids a worker keeps at a time.
REMEMBERED = 200_000
#: Rows a worker returns at a time.
ROWS = 256


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Words(dict):
    """The ids of words with a blank before them, found when first asked for."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.find(BLANK + word)
        return found


class Pieces:
    """A merge-type model's pieces, read with the sentencepiece library."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.length: list[int] = []
        self.plain: list[bytes] = []
        for i in range(len(model)):
            piece = model.id_to_piece(i)
            self.length.append(len(piece))
            plain = b"" if model.is_control(i) else piece.replace(BLANK, " ").encode()
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                plain = bytes([int(piece[3:5], 16)])
            elif model.is_unknown(i):
                plain = " ⁇ ".encode()
            elif not model.is_control(i) and not model.is_unused(i):
                self.score[piece], self.id[piece] = model.get_score(i), i
            self.plain.append(plain)
        self.text = {i: piece for piece, i in self.id.items()}
        self.decimal = [str(i) for i in range(len(model))]
        self.matches = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.matches.add_word(piece, i)
        self.matches.make_automaton()
        letters = set("".join(self.id))
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            raise ValueError("a piece has a blank after another letter")
        apart = "".join(c for c in "\n\t\r" if c not in letters)
        # Signs that no piece holds after a letter begin a part of their own there.
        after = {b for p in self.id for a, b in zip(p, p[1:]) if a.isalnum()}
        signs = "".join(re.escape(c) for c in ",.;:!?()[]{}|#%&$*\"" if c not in after)
        places = [f"(?<=[^{BLANK}])(?={BLANK})"]
        if apart:
            places += [f"(?=[{apart}])", f"(?<=[{apart}])"]
        if signs:
            places.append(f"(?<=[^\\W_])(?=[{signs}])")
        self.parts = re.compile("|".join(places)).split
        self.stay: dict[int, bool] = {}
        self.known_parts: dict[str, bytes] = {}
        self.known = _Words(self.text_bytes)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging, best score and then leftmost first."""
        out = list(text)
        while True:
            best, at = None, -1
            for i in range(len(out) - 1):
                score = self.score.get(out[i] + out[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return out
            out[at : at + 2] = [out[at] + out[at + 1]]

    def apart(self, before: int, piece: int) -> bool:
        """Whether two pieces side by side stay as they are; -1: nothing before."""
        pair = [self.text[piece]] if before < 0 else [self.text[before], self.text[piece]]
        found = self.stay[before << 20 | piece] = self.merged("".join(pair)) == pair
        return found

    def part_ids(self, part: str) -> list[int]:
        """The ids of one part of a text."""
        last = [-1] * (len(part) + 1)
        stay, length = self.stay.get, self.length
        for end, piece in self.matches.iter(part):
            end += 1
            if last[end] < 0:
                before = last[end - length[piece]]
                fits = stay(before << 20 | piece)
                if fits is None:
                    fits = self.apart(before, piece)
                if fits:
                    last[end] = piece
        ids, at = [], len(part)
        while at:
            piece = last[at]
            if piece < 0:
                ids += [self.byte[b] for b in reversed(part[at - 1].encode())]
                at -= 1
            else:
                ids.append(piece)
                at -= length[piece]
        ids.reverse()
        return ids

    def text_bytes(self, text: str) -> bytes:
        """The ids of a text with blanks marked, as little-endian 32-bit integers."""
        known, out = self.known_parts, []
        for part in self.parts(text):
            found = known.get(part)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[part] = array("i", self.part_ids(part)).tobytes()
            out.append(found)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<i4")
        if BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
            found = self.text_bytes(BLANK + text.replace(" ", BLANK))
        else:  # one blank before each word
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(self.stay) >= 3 * REMEMBERED:
                self.stay.clear()
            found = b"".join(map(self.known.__getitem__, text.split(" ")))
        return np.frombuffer(found, dtype="<i4")

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """The model, loaded once in each worker."""
    return kept(("pieces", path), lambda: Pieces(path))


def _ids_array(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in found]).astype("int32")
    flat = np.concatenate(found) if found else np.zeros(0, dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=pa.int32()))


def encode(docs: DataFrame, column: str = "text", ids: str = "ids", decoded: str | None = None, path: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``column`` as an array of integers and, if
    ``decoded`` is given, the text decoded from them in the same pass; equally
    named columns are replaced."""
    path = path or model_path()
    others = docs.drop(ids, *([decoded] if decoded else []))
    more = [T.StructField(ids, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts = batch.column(batch.schema.get_field_index(column))
                found = [model.encode(x.as_py() or "") for x in texts]
                made = [_ids_array(found)]
                if decoded:
                    made.append(pa.array([model.decode(x.tolist()) for x in found], type=pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.name for f in more]])

    return others.mapInArrow(run, T.StructType([*others.schema.fields, *more]))


def decode(df: DataFrame, ids: str = "ids", column: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of its ids; null ids give an empty text."""
    path = path or model_path()
    others = df.drop(column)
    schema = T.StructType([*others.schema.fields, T.StructField(column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                lists = batch.column(batch.schema.get_field_index(ids))
                texts = [model.decode(x.as_py() or []) for x in lists]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=[*batch.schema.names, column])

    return others.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, decodes the
    ids again and keeps digests only, in one pass."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            n, own, back = [], [], []
            for x in batch.column(1):
                ids = model.encode(x.as_py() or "").tolist()
                n.append(len(ids))
                own.append(hashlib.sha256(",".join(map(model.decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, type=pa.int64()), pa.array(own, type=pa.string()), pa.array(back, type=pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
