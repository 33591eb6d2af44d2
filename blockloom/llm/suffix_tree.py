"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context: the words before a place, up to ``depth`` of
them, a document's start counting as one. A context found at a share of
``SHARE`` of all places, and ``LEAST`` times at least, is tested against what
the longest kept context inside it predicts: if the divergence of its own
next-word distribution, times its occurrences, exceeds ``PRICE`` for each word
it predicts, it is kept. So contexts have different lengths, and a place is
scored by the longest kept one that ends there.

A kept context predicts each word that followed it ``REPEATED`` times or more
by its count less ``DISCOUNT``, over its occurrences plus ``PRIOR``; the rest
of its mass goes to all words as the next shorter kept context predicts them.
The empty context predicts a word from its count plus ``ADDED`` and gives all
unknown words the share of one. Every distribution sums to 1.

How it runs. Words are numbered inside batches of documents, which are stored
once, bucketed by batch. What a batch counts (words, words after contexts,
sums for the test) goes as sorted 64-bit hashes to as many buckets as the
corpus asks for; a bucket adds up what all batches sent and answers each one
about just the hashes it asked for. A word of a third of all tokens is one
hash a batch. Batches stay where they are and meet only their answers, so
counts, tests and scores cover all documents, no table of the whole corpus is
gathered anywhere, and what moves grows with the corpus.

Words and contexts are told apart by 64-bit hashes; two of one hash would
count as one. Only contexts whose shorter forms and last words can reach the
counts asked for are counted at all, which loses none.

Nulls and ties: a null text counts as empty and has its end as only token.
Rows that ``learn`` is not true for are scored but not learned from. Repeated
rows count again and are scored alike. A text longer than a batch is a batch
of its own. With nothing to learn from, every token has the chance 1. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, stage, unstage
from .common import table

DEPTH = 3
#: A context needs such a share of all places and so many occurrences, a word after it so many repeats.
SHARE, LEAST, REPEATED = 2e-6, 32, 2
PRIOR, DISCOUNT, PRICE = 20.0, 0.5, 3.0
ADDED = 0.1
#: Tokens of a batch, a document more at most; hashes a bucket gets on average at most.
BATCH, BUCKET = 1_000_000, 2_000_000

# Hashes of the end and the start of a document: no word holds a line feed.
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b"\n\n")
COUNTS, SUMS = 0, 1

BATCHES = "batch long, doc_ids array<long>, learned array<boolean>, sizes array<int>, ids binary, words binary, tokens long, texts long"
SENT = "batch long, kind int, length int, bucket int, hashes binary, numbers binary"
ANSWERED = "batch long, kind int, length int, bucket int, wide int, answers binary, known long, total long"


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _batches(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, learned, text) as numbered words, a row per batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, itertools.count()

        def fresh():
            known = defaultdict(itertools.count(1).__next__)
            return known, [], [], [], []

        def row(known, ids, learned, sizes, numbers):
            words = np.fromiter(itertools.chain([END], map(xxhash.xxh64_intdigest, known)), dtype=np.uint64, count=len(known) + 1)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task + next(number)], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([learned], pa.list_(pa.bool_())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([pack(np.concatenate(numbers))], pa.binary()),
                    pa.array([words.tobytes()], pa.binary()),
                    pa.array([sum(sizes)], pa.int64()),
                    pa.array([sum(learned)], pa.int64()),
                ],
                names=["batch", "doc_ids", "learned", "sizes", "ids", "words", "tokens", "texts"],
            )

        known, ids, learned, sizes, numbers = fresh()
        held = 0
        for part in parts:
            for doc_id, use, text in zip(*(part.column(i) for i in range(3))):
                # On bytes, lower() changes A-Z alone and split() parts at the six kinds of white space.
                words = (text.as_py() or "").encode().lower().split()
                if held and held + len(words) >= BATCH:
                    yield row(known, ids, learned, sizes, numbers)
                    known, ids, learned, sizes, numbers = fresh()
                    held = 0
                place = np.zeros(len(words) + 1, dtype=np.int32)
                place[:-1] = np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))
                ids.append(doc_id.as_py())
                learned.append(use.as_py())
                sizes.append(len(place))
                numbers.append(place)
                held += len(place)
        if ids:
            yield row(known, ids, learned, sizes, numbers)

    return docs.mapInArrow(run, BATCHES)


def _grown(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a context with one more word."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Sent:
    """Sorted hashes of one kind and context length, with a row of numbers for each quantity."""

    kind: int
    length: int
    hashes: np.ndarray
    numbers: np.ndarray

    def rows(self, batch: int, buckets: int) -> Iterator[tuple]:
        """A row per bucket that gets any; buckets are ranges of hashes."""
        bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
        cuts = [0, *np.searchsorted(self.hashes, bounds).tolist(), len(self.hashes)]
        for bucket, (low, high) in enumerate(zip(cuts, cuts[1:])):
            if low < high:
                steps = np.diff(self.hashes[low:high], prepend=np.uint64(0))
                yield batch, self.kind, self.length, bucket, pack(steps), pack(np.ascontiguousarray(self.numbers[:, low:high]))


@dataclass(frozen=True)
class Rules:
    """The parameters, and the sizes of what is learned from."""

    depth: int
    least: int
    price: float
    buckets: int
    texts: int
    known: int = 0
    total: int = 0


def _merged(rules: Rules):
    """Adds up what batches sent to a bucket and answers each of them."""

    def run(key: tuple, block: pa.Table) -> pa.Table:
        kind, length, bucket = (k.as_py() for k in key)
        order = np.argsort(block["batch"].to_numpy(), kind="stable")
        # The first one that has a hash owns it; each bucket begins with another batch.
        order = np.roll(order, bucket).tolist()
        batches = block["batch"].to_numpy()[order]
        hashes = [np.cumsum(unpack(block["hashes"][i].as_py(), "u8"), dtype=np.uint64) for i in order]
        numbers = [unpack(block["numbers"][i].as_py(), "f8").reshape(-1, len(h)) for i, h in zip(order, hashes)]
        numbers = np.concatenate(numbers, axis=1)
        places, owner, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        if kind == COUNTS:
            count = np.bincount(inverse, numbers[0], len(places)).astype(np.int64)
            known, total = int((count > 0).sum()), int(count.sum())
            answer = count[inverse]
            if length:
                # Twice the count, and one more for the owner.
                answer = 2 * answer
                answer[owner] += 1
                answer[answer < 2 * REPEATED] = 0
            answer = answer.astype(np.uint32 if count.max() < 1 << 31 else np.uint64)
        else:
            told, before, mass, followers = (np.bincount(inverse, row, len(places)) for row in numbers[:4])
            n = np.zeros(len(places))
            np.maximum.at(n, inverse, numbers[4])
            left = np.maximum(1 - (mass - DISCOUNT * followers) / (n + PRIOR), 1e-12)
            divergence = n * (told + left * np.log(left / np.maximum(1 - before, 1e-12)))
            # A kept context's answer is the mass that goes to the next shorter one.
            answer = np.where((followers > 0) & (divergence > rules.price * (followers + 1)), left, -1.0)
            known, total = int((answer >= 0).sum()), len(places)
            answer = answer[inverse]
        cuts = np.cumsum([0, *map(len, hashes)])
        first = np.arange(len(batches)) == 0
        return pa.table(
            {
                "batch": pa.array(batches, pa.int64()),
                "kind": pa.array([kind] * len(batches), pa.int32()),
                "length": pa.array([length] * len(batches), pa.int32()),
                "bucket": pa.array([bucket] * len(batches), pa.int32()),
                "wide": pa.array([answer.dtype.itemsize] * len(batches), pa.int32()),
                "answers": pa.array([pack(answer[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                "known": pa.array(np.where(first, known, 0), pa.int64()),
                "total": pa.array(np.where(first, total, 0), pa.int64()),
            }
        )

    return run


def _answers(block: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """What buckets answered, in the order of the hashes they were asked about."""
    parts: dict[tuple[int, int], list] = defaultdict(list)
    for row in block.select(["kind", "length", "bucket", "wide", "answers"]).to_pylist():
        kind = "f8" if row["kind"] == SUMS else f"u{row['wide']}"
        parts[row["kind"], row["length"]].append((row["bucket"], unpack(row["answers"], kind)))
    return {key: np.concatenate([values for _, values in sorted(some, key=lambda x: x[0])]) for key, some in parts.items()}


def _shifted(values: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """Each place's value at the place before it, ``start`` where a document begins."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = start
    return out


class _Places:
    """A batch token by token: counts, contexts and chances, as far as answers go."""

    def __init__(self, row: dict, rules: Rules) -> None:
        self.rules, self.row = rules, row
        self.ids = unpack(row["ids"], "i4")
        self.words = np.frombuffer(row["words"], dtype="u8")
        self.word = self.words[self.ids]
        sizes = np.array(row["sizes"], dtype=np.int64)
        self.start = np.cumsum(sizes) - sizes
        self.first = np.zeros(len(self.ids), dtype=bool)
        self.first[self.start] = True
        self.learned = np.repeat(np.array(row["learned"], dtype=bool), sizes)

    def walk(self, step: int, answers: dict[tuple[int, int], np.ndarray]) -> tuple[list[Sent], np.ndarray | None, np.ndarray | None]:
        """What to ask after ``step`` rounds of answers, and the counts of words
        and the chances of places if they are known."""
        rules, none = self.rules, np.zeros(0)
        hashes, inverse = np.unique(self.words, return_inverse=True)
        if step == 0:
            count = np.bincount(inverse, np.bincount(self.ids, self.learned, len(self.words)), len(hashes))
            return [Sent(COUNTS, 0, hashes, count[None])], None, None
        count = answers[COUNTS, 0][inverse][self.ids].astype(np.int64)
        chance = (count + ADDED) / (rules.total + ADDED * (rules.known + 1))
        context, seen, follows = _shifted(self.word, self.first, np.uint64(START)), _shifted(count, self.first, rules.texts), count
        asked: list[Sent] = []
        for length in range(1, rules.depth + 1):
            alive = np.flatnonzero(seen >= rules.least)
            # A word follows a context no more often than any shorter one.
            at = alive[follows[alive] >= REPEATED]
            grown = _grown(context[at], self.word[at])
            hashes, one, inverse = np.unique(grown, return_index=True, return_inverse=True)
            if length >= step:
                asked.append(Sent(COUNTS, length, hashes, np.bincount(inverse, self.learned[at], len(hashes))[None]))
                break
            answer = answers.get((COUNTS, length), none).astype(np.int64)
            follows = np.zeros(len(self.ids), dtype=np.int64)
            follows[at] = answer[inverse] >> 1
            if length >= step - 1:
                asked.append(self._sums(length, context, seen, follows, chance, alive, at[one[answer % 2 == 1]]))
                chance = None
            else:
                _, place = np.unique(context[alive], return_inverse=True)
                left = answers.get((SUMS, length), none)[place]
                at, left = alive[left >= 0], left[left >= 0]
                chance[at] = self._share(follows[at], seen[at]) + left * chance[at]
            longer = np.zeros(len(self.ids), dtype=np.uint64)
            rows = np.flatnonzero(follows)
            longer[rows] = _grown(context[rows], self.word[rows])
            context, seen = _shifted(longer, self.first, np.uint64(0)), _shifted(follows, self.first, 0)
        return asked, count, chance

    @staticmethod
    def _share(follows: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """What a context itself gives the word that follows it."""
        return np.where(follows > 0, follows - DISCOUNT, 0) / (seen + PRIOR)

    def _sums(self, length, context, seen, follows, chance, alive, owned) -> Sent:
        """Sums over the words that follow each context, each word in the batch
        that owns it; the other batches only ask."""
        contexts = np.unique(context[alive])
        place = np.searchsorted(contexts, context[owned])
        share, before = self._share(follows[owned], seen[owned]), chance[owned]
        sums = [share * np.log(share / before), before, follows[owned], np.ones(len(owned))]
        n = np.zeros(len(contexts))
        n[place] = seen[owned]
        return Sent(SUMS, length, contexts, np.stack([*(np.bincount(place, s, len(contexts)) for s in sums), n]))

    def scores(self, count: np.ndarray, chance: np.ndarray) -> dict:
        base = (count + ADDED) / (self.rules.total + ADDED * (self.rules.known + 1))
        add = lambda values: np.add.reduceat(values, self.start)
        return {
            "doc_id": pa.array(self.row["doc_ids"], pa.int64()),
            "learned": pa.array(self.row["learned"], pa.bool_()),
            "n_tokens": pa.array(self.row["sizes"], pa.int64()),
            "n_known": pa.array(add((count > 0).astype(np.int64)), pa.int64()),
            "base_score": pa.array(add(np.log10(base)), pa.float64()),
            "score": pa.array(add(np.log10(chance)), pa.float64()),
        }


def _asked(rules: Rules, step: int):
    def run(_: tuple, batch: pa.Table, answers: pa.Table) -> pa.Table:
        row = batch.to_pylist()[0]
        sent, _, _ = _Places(row, rules).walk(step, _answers(answers))
        rows = [r for s in sent for r in s.rows(row["batch"], rules.buckets)]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = zip(*rows) if rows else [[]] * 6
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=["batch", "kind", "length", "bucket", "hashes", "numbers"])

    return run


def _scored(rules: Rules):
    def run(_: tuple, batch: pa.Table, answers: pa.Table) -> pa.Table:
        places = _Places(batch.to_pylist()[0], rules)
        _, count, chance = places.walk(rules.depth + 2, _answers(answers))
        return pa.table(places.scores(count, chance))

    return run


def _bucketed(batches: DataFrame) -> tuple[DataFrame, str]:
    """Batches written once in buckets, so that no round moves them again."""
    spark, name = batches.sparkSession, f"batches_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches.write.bucketBy(buckets, "batch").option("path", fresh_path(spark, "batches")).saveAsTable(name)
    return spark.table(name), name


def scored(docs: DataFrame, learn: Column, depth: int = DEPTH, least: int = LEAST, price: float = PRICE, share: float = SHARE) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of
    all ``docs`` (doc_id, text), learned from those that ``learn`` is true for."""
    spark = docs.sparkSession
    batches, name = _bucketed(_batches(docs.select(F.col("doc_id").cast("long"), F.coalesce(learn, F.lit(False)).alias("learned"), "text")))
    size = batches.agg(F.sum("tokens").alias("tokens"), F.sum("texts").alias("texts")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size["tokens"] or 0) // BUCKET))
    rules = Rules(depth, least, price, buckets, size["texts"] or 0)
    answers = [spark.createDataFrame([], ANSWERED)]

    def met(function, schema: str) -> DataFrame:
        got = answers[0]
        for more in answers[1:]:
            got = got.unionByName(more)
        return batches.groupBy("batch").cogroup(got.groupBy("batch")).applyInArrow(function, schema)

    # Words; words after one word; then each length's test with the next one's counts.
    for step in range(depth + 2):
        sent = met(_asked(rules, step), SENT)
        answers.append(stage(sent.groupBy("kind", "length", "bucket").applyInArrow(_merged(rules), ANSWERED), "answers"))
        if step == 0:
            found = answers[-1].agg(F.sum("known").alias("known"), F.sum("total").alias("total")).first()
            known, total = found["known"] or 0, found["total"] or 0
            rules = replace(rules, known=known, total=total, least=max(least, math.ceil(share * total)))
    out = "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double"
    result = stage(met(_scored(rules), out), "scores")
    for part in [batches, *answers[1:]]:
        unstage(part)
    spark.sql(f"drop table {name}")
    return result.withColumn("train_tokens", F.lit(rules.total).cast("long"))


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    found = scored(table(spark, sf_dir, "documents"), learn)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
