"""Language identification by hyperdimensional profiles.

Each letter has a random vector of -1 and 1, drawn from its code point. The
vector of three letters is the product of the letters' vectors, the first
permuted twice and the second once (binding by rotation); a text is the sum of
its letter triples (bundling), a language the sum of its documents' unit
vectors. A document gets the language of the largest cosine.

A triple's count times its vector is one matrix product per batch of texts,
so a worker holds the vectors of the triples it meets and nothing more.
Language vectors are sums of whole numbers and do not depend on the order in
which Spark adds them up. The fit takes a bounded sample of the rows it may
learn from (``FIT_ROWS``), chosen by a hash of the id.

Nulls and ties: a null text, and one without a letter, is ``und`` with score
0; so is every text if nothing was learned. Equal cosines go to the language
first in code-point order. A null doc_id is held out. Repeated rows are
predicted alike; an empty table gives an empty result; other columns pass
through ``identify``, but for ``lang_pred`` and ``score``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, held_out, kept, table

#: Components of a vector.
SIZE = 1024
#: Documents that the fit reads at most.
FIT_ROWS = 20_000
#: What a unit vector's components are multiplied by before they are rounded and summed up.
GRAIN = 1 << 20
#: Standard deviations of chance cosines that a text in a learned language is above 0.
CHANCE = 3.0
SEED = 11
UNKNOWN = "und"
#: Texts and letters in one matrix product; longer texts are summed up over parts.
TEXTS, LETTERS = 256, 1 << 20
#: Distinct triples whose vectors are held at once.
TRIPLES = 8192


class _Letters:
    """Letters as numbers (0: no letter), and their vectors."""

    def __init__(self) -> None:
        self.of = np.array([i if chr(i).isalpha() else 0 for i in range(0x110000)], dtype=np.uint32)
        self.vectors: dict[int, np.ndarray] = {}
        self.place = np.zeros(0x110000, dtype=np.int64)

    def vector(self, letter: int) -> np.ndarray:
        found = self.vectors.get(letter)
        if found is None:
            found = np.random.default_rng([SEED, letter]).integers(0, 2, SIZE).astype(np.int8) * 2 - 1
            self.vectors[letter] = found
        return found


def letters() -> _Letters:
    return kept(("letters", SEED), _Letters)


def bundle(texts: list[str]) -> np.ndarray:
    """The vectors of some texts, one row each."""
    known = letters()
    out = np.zeros((len(texts), SIZE), dtype=np.float32)
    raw = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    owner = np.concatenate([owner[:1], owner])
    letter = known.of[raw]
    keep = np.ones(len(letter), dtype=bool)
    keep[1:] = (letter[1:] != 0) | (letter[:-1] != 0)
    letter, owner = letter[keep], owner[keep]
    here = np.flatnonzero(letter[1:-1])
    if not len(here):
        return out
    seen = np.zeros(0x110000, dtype=bool)
    seen[letter] = True
    alphabet = np.flatnonzero(seen)
    known.place[alphabet] = np.arange(len(alphabet))
    at, n = known.place[letter], len(alphabet)
    code = (at[here] * n + at[here + 1]) * n + at[here + 2]
    owner = owner[here + 1]
    if n**3 <= 1 << 22:
        met = np.zeros(n**3, dtype=bool)
        met[code] = True
        triples = np.flatnonzero(met)
        place = np.zeros(n**3, dtype=np.int64)
        place[triples] = np.arange(len(triples))
        triple = place[code]
    else:
        triples, triple = np.unique(code, return_inverse=True)
    vectors = np.stack([known.vector(int(x)) for x in alphabet])
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    for low in range(0, len(triples), TRIPLES):
        part = triples[low : low + TRIPLES]
        mine = slice(None) if len(triples) <= TRIPLES else (triple >= low) & (triple < low + TRIPLES)
        count = np.bincount(owner[mine] * len(part) + (triple[mine] - low), minlength=len(texts) * len(part))
        bound = twice[part // (n * n)] * once[part // n % n] * vectors[part % n]
        out += count.reshape(len(texts), len(part)).astype(np.float32) @ bound.astype(np.float32)
    return out


def unit_vectors(texts: list[str | None]) -> np.ndarray:
    """The texts' vectors at length 1; zeros for texts without letters."""
    parts: list[str] = []
    owner: list[int] = []
    out = np.zeros((len(texts), SIZE), dtype=np.float64)
    size = 0

    def add() -> None:
        nonlocal size
        np.add.at(out, owner, bundle(parts))
        parts.clear()
        owner.clear()
        size = 0

    for i, text in enumerate(texts):
        text = (text or "").lower()
        for low in range(0, len(text), LETTERS):
            part = text[low : low + LETTERS]
            parts.append(part)
            owner.append(i)
            size += len(part)
            if size >= LETTERS or len(parts) >= TEXTS:
                add()
    if parts:
        add()
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length == 0, 1, length)


def fit(docs: DataFrame, most: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their unit vectors, learned from text
    and non-null lang of the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = bounded_sample(rows, "doc_id", most).select("lang", "text")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                units = np.rint(unit_vectors(batch.column(1).to_pylist()) * GRAIN).astype(np.int64)
                for lang, unit in zip(batch.column(0).to_pylist(), units):
                    total[lang] = total[lang] + unit if lang in total else unit
        for lang, vector in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * SIZE, type=pa.string()), pa.array(np.arange(SIZE, dtype="int32")), pa.array(vector)],
                names=["lang", "at", "value"],
            )

    # SIZE rows for each language: as many as the model has numbers.
    found = rows.mapInArrow(sums, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    names: dict[str, np.ndarray] = {}
    for lang, at, value in found.collect():
        names.setdefault(lang, np.zeros(SIZE))[at] = value
    languages = sorted(x for x in names if names[x].any())
    vectors = np.array([names[x] / np.linalg.norm(names[x]) for x in languages]).reshape(len(languages), SIZE)
    return languages, vectors


def identify(docs: DataFrame, languages: list[str], vectors: np.ndarray, column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    others = docs.drop("lang_pred", "score")
    schema = T.StructType([*others.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                units = unit_vectors(batch.column(batch.schema.get_field_index(column)).to_pylist())
                lang, score = [UNKNOWN] * len(units), np.zeros(len(units))
                if languages:
                    cosine = np.round(units @ vectors.T, 9)
                    best = cosine.argmax(axis=1)
                    some = units.any(axis=1)
                    score = np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0)
                    lang = [languages[b] if s else UNKNOWN for b, s in zip(best, some)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lang, type=pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
                )

    return others.mapInArrow(run, schema)


def known_language(docs: DataFrame, most: int = FIT_ROWS, chance: float = CHANCE) -> DataFrame:
    """The rows in a language that was learned, all columns as they were.

    Vectors that have nothing to do with each other have cosines spread round
    0 by ``1 / sqrt(SIZE)``. A text whose best cosine is not ``chance`` such
    deviations above 0 shares no more letter triples with any language than
    chance gives: it is in none of them and goes, like null texts and those
    without a letter. If nothing was learned, only the latter go.
    """
    languages, vectors = fit(docs, most)
    least = chance / np.sqrt(SIZE) if languages else 0.0
    if not languages:
        # Any profile tells texts with letters from those without.
        languages, vectors = ["any"], np.zeros((1, SIZE))
    named = identify(docs.withColumnRenamed("score", "_score").withColumnRenamed("lang_pred", "_lang_pred"), languages, vectors)
    named = named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= float(least))).drop("lang_pred", "score")
    return named.withColumnRenamed("_score", "score").withColumnRenamed("_lang_pred", "lang_pred").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), *fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
