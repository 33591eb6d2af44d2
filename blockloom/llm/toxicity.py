"""Toxicity by a factorization machine over hashed terms.

A term's weight says how much it counts alone; the product of two terms'
factor vectors says how much they count together, so an insult beside the
name of a group can weigh more than both apart. The sum over all pairs is
worked out in time linear in a text's terms.

Every term in at least ``LEAST_TEXTS`` texts of the sample is learned. A term
counts in full if its own share of label 1, or that of any pair with it, is far
from what chance explains, and is damped towards ``DAMPED`` if not, so the many
terms that say nothing do not drown the few that do.

Terms are the lower-case words of a text and their beginnings, hashed into
``SPACE`` places; a term counts once in a text. The fit takes a bounded sample
of labelled rows (``FIT_EACH``), as many of either label where there are
enough, weighed back to their shares; only hashed terms reach the driver. The
pairs of the sample's terms are counted by tasks, a block of terms against
another in each.

Nulls and ties: a null text counts as empty; a text without words gets the
score of the bias alone. Labels without a document, null labels and labels of
null ids are not learned from. Without labels every score is 0.5. Repeated
rows are scored alike; an empty table gives an empty result; other columns
pass through ``assess``, but for ``score``, which is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, held_out, table

#: Labelled rows of either label that the fit reads at most.
FIT_EACH = 8_000
SPACE = 1 << 18
FACTORS = 4
#: Lengths of the beginnings of words.
STARTS = (4, 5, 6, 7)
BATCH, RATE = 256, 0.1
#: Passes over the sample: as many as make so many steps, within limits.
STEPS, EPOCHS = 400, (6, 60)
#: Pulls weights and factors towards 0.
SHRINK, SHRINK_FACTORS = 1e-4, 1e-3
#: Terms in fewer texts of the sample have no weight.
LEAST_TEXTS = 3
#: Terms that say less than so many standard deviations, alone and with any
#: other term, are damped, by DAMPED at most, but none is left out.
LEAST_SIGNAL, DAMPED = 3.0, 0.03
#: Terms of a block, and pairs in texts that are counted at once.
PAIRS, AT_ONCE = 512, 4_000_000
REMEMBERED = 300_000
SEED = 5

_words = re.compile(r"[^\W_]+").findall


class Terms(dict):
    """The hashed terms of words, found when first asked for; only those of
    ``useful`` if it is given."""

    def __init__(self, useful: np.ndarray | None = None) -> None:
        super().__init__()
        self.useful = None if useful is None else frozenset(useful.tolist())

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        starts = [word[:k] for k in STARTS if len(word) > k]
        found = [zlib.crc32(x.encode()) % SPACE for x in [f"={word}", *(f"^{s}" for s in starts)]]
        found = self[word] = tuple(found if self.useful is None else [x for x in found if x in self.useful])
        return found

    def of(self, text: str | None) -> np.ndarray:
        """The distinct hashed terms of a text, in order."""
        found: set[int] = set()
        for places in map(self.__getitem__, set(_words((text or "").lower()))):
            if places:
                found.update(places)
        return np.array(sorted(found), dtype=np.int32)


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All terms in a row, and the row of each."""
    size = [len(r) for r in rows]
    return np.concatenate([*rows, np.zeros(0, dtype=np.int32)]), np.repeat(np.arange(len(rows), dtype=np.int32), size)


@dataclass
class Machine:
    """A bias, and the weight and factors of each place that has any."""

    bias: float
    places: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        at, row = _flat(rows)
        place = np.full(SPACE, -1, dtype=np.int32)
        place[self.places] = np.arange(len(self.places))
        at = place[at]
        at, row = at[at >= 0], row[at >= 0]
        out += np.bincount(row, self.weight[at], len(rows))
        for f in self.factor.T:
            v = f[at]
            total = np.bincount(row, v, len(rows))
            out += 0.5 * (total * total - np.bincount(row, v * v, len(rows)))
        return np.round(1 / (1 + np.exp(-np.clip(out, -30, 30))), 9)


@dataclass
class Pairs:
    """The terms whose pairs are looked at, by the texts that hold them, and
    what is known of them alone."""

    #: Texts in all, and those of label 1, which come first.
    texts: int
    ones: int
    #: All terms' texts in a row, and where each term's begin and end.
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray
    odds: np.ndarray
    #: What the best of so many pairs shows by chance.
    chance: float

    def blocks(self) -> list[tuple[int, int]]:
        starts = range(0, len(self.low), PAIRS)
        return [(i, j) for i in starts for j in starts if j >= i]

    def _block(self, start: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The texts and terms of a block, text by text, and its number of terms."""
        end = min(start + PAIRS, len(self.low))
        text = self.row[self.low[start] : self.high[end - 1]]
        term = np.repeat(np.arange(end - start), self.high[start:end] - self.low[start:end])
        order = np.argsort(text, kind="stable")
        return text[order], term[order], end - start

    def signal(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """For each term of two blocks, the standard deviations by which the pair
        that says most differs from its two terms' shares added up. Only pairs
        that stand in a text are counted."""
        (text, a, n), (other, b, m) = self._block(i), self._block(j)
        many = np.bincount(other, minlength=self.texts)
        begin = np.cumsum(many) - many
        bad, both = np.zeros(n * m, dtype=np.int64), np.zeros(n * m, dtype=np.int64)
        # Up to some million pairs at a time, however long the texts are.
        cuts = np.searchsorted(np.cumsum(many[text]), np.arange(AT_ONCE, many[text].sum(), AT_ONCE), "right")
        cuts = np.unique([0, *cuts, np.searchsorted(text, self.ones), len(text)])
        for low, high in zip(cuts, cuts[1:]):
            times = many[text[low:high]]
            place = np.arange(times.sum()) + np.repeat(begin[text[low:high]] - (np.cumsum(times) - times), times)
            found = np.bincount(np.repeat(a[low:high], times) * m + b[place], minlength=n * m)
            both += found
            if text[low] < self.ones:
                bad += found
        at = np.flatnonzero(both >= LEAST_TEXTS)
        if j == i:
            at = at[at // m != at % m]
        bad, both = bad[at].astype(float), both[at].astype(float)
        q = 1 / (1 + np.exp(-np.clip(self.odds[i + at // m] + self.odds[j + at % m], -30, 30)))

        def part(count: np.ndarray, expected: np.ndarray) -> np.ndarray:
            return count * np.log(np.maximum(count, 1e-6) / np.maximum(expected, 1e-6))

        told = 2 * (part(bad, both * q) + part(both - bad, both * (1 - q))) - self.chance
        told = np.sqrt(np.maximum(told, 0))
        mine, theirs = np.zeros(n), np.zeros(m)
        np.maximum.at(mine, at // m, told)
        np.maximum.at(theirs, at % m, told)
        return mine, theirs


def _on_driver(pairs: Pairs) -> np.ndarray:
    out = np.zeros(len(pairs.low))
    for i, j in pairs.blocks():
        mine, other = pairs.signal(i, j)
        out[i : i + PAIRS] = np.maximum(out[i : i + PAIRS], mine)
        out[j : j + PAIRS] = np.maximum(out[j : j + PAIRS], other)
    return out


def _on_executors(spark: SparkSession) -> Callable[[Pairs], np.ndarray]:
    """Block pairs as tasks; each executor gets the sample's terms once."""

    def run(pairs: Pairs) -> np.ndarray:
        out, blocks = np.zeros(len(pairs.low)), pairs.blocks()
        if not blocks:
            return out
        sent = spark.sparkContext.broadcast(pairs)

        def signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    i, j = blocks[at]
                    for start, found in zip((i, j), sent.value.signal(i, j)):
                        some = np.flatnonzero(found)
                        yield pa.RecordBatch.from_arrays([pa.array(some + start, pa.int64()), pa.array(found[some], pa.float64())], names=["term", "told"])

        best = spark.range(len(blocks), numPartitions=min(len(blocks), 64)).mapInArrow(signals, "term long, told double")
        # A row per term that any pair says something of, out of SPACE at most.
        best = best.groupBy("term").agg(F.max("told").alias("told")).toArrow()
        out[best["term"].to_numpy()] = best["told"].to_numpy()
        sent.unpersist()
        return out

    return run


def _pair_signal(rows: list[np.ndarray], y: np.ndarray, seen: np.ndarray, toxic: np.ndarray, looked: Callable[[Pairs], np.ndarray]) -> np.ndarray:
    """For each term, the standard deviations by which the pair that says most
    differs from its two terms' shares added up, less what the best of so many
    pairs shows by chance. Rows hold terms numbered from 0."""
    out, p, n = np.zeros(len(seen)), y.mean(), len(seen)
    if n < 2 or not 0 < p < 1:
        return out
    chance = 2 * np.log(n * n / 2)
    # With fewer texts of a label no pair gets beyond chance.
    some = np.flatnonzero((toxic >= chance / (-2 * np.log(p))) | (seen - toxic >= chance / (-2 * np.log(1 - p))))
    # Terms of the same texts say the same, so one of them stands for all.
    mark, sums = np.random.default_rng(SEED).random(len(y)), np.zeros(n)
    for i, r in enumerate(rows):
        sums[r] += mark[i]
    _, first, same = np.unique(np.stack([sums[some], seen[some]]), axis=1, return_index=True, return_inverse=True)
    order = np.argsort(first)
    like, some, same = some, some[first[order]], np.argsort(order)[same.ravel()]
    share = (toxic + p) / (seen + 1)
    odds = (np.log(share / (1 - share)) - np.log(p / (1 - p)) / 2).astype(np.float32)
    order = np.argsort(-y, kind="stable")
    there = np.isin(np.arange(n), some)
    at, row = _flat([rows[i][there[rows[i]]] for i in order])
    turn = np.argsort(at, kind="stable")
    at, row = at[turn], row[turn]
    low, high = np.searchsorted(at, some), np.searchsorted(at, some, "right")
    found = looked(Pairs(len(y), int(y.sum()), row, low, high, odds[some], chance))
    out[like] = found[same]
    return out


def fit_rows(rows: list[np.ndarray], y: np.ndarray, importance: np.ndarray, looked: Callable[[Pairs], np.ndarray] = _on_driver) -> Machine:
    """The machine of term rows and labels by stochastic gradients with steps
    that shrink place by place; the same whatever the order of rows."""
    if not len(y):
        return Machine(0.0, np.zeros(0, dtype=np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    order = sorted(range(len(rows)), key=lambda i: (zlib.crc32(rows[i].tobytes()), rows[i].tobytes(), y[i]))
    rows, y, importance = [rows[i] for i in order], y[order], importance[order]
    # Sums over slices: the driver holds the rows once.
    seen, toxic = np.zeros(SPACE), np.zeros(SPACE)
    for low in range(0, len(rows), BATCH):
        at, row = _flat(rows[low : low + BATCH])
        seen += np.bincount(at, minlength=SPACE)
        toxic += np.bincount(at, y[low + row], minlength=SPACE)
    useful = seen >= LEAST_TEXTS
    places = np.flatnonzero(useful).astype(np.int32)
    number = np.cumsum(useful, dtype=np.int32) - 1
    for i, r in enumerate(rows):
        rows[i] = number[r[useful[r]]]
    seen, toxic = seen[places], toxic[places]
    expected = seen * y.mean()
    told = np.abs(toxic - expected) / np.sqrt(np.maximum(expected * (1 - y.mean()), 1e-9))
    told = np.maximum(told, _pair_signal(rows, y, seen, toxic, looked))
    much = np.clip((told / LEAST_SIGNAL) ** 2, DAMPED, 1).astype(np.float32)
    rng = np.random.default_rng(SEED)
    rate = float((importance * y).sum() / importance.sum())
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    bias = float(np.log(rate / (1 - rate)))
    # A term's weight, then its factors; a row each, so sums run along memory.
    model = np.vstack([np.zeros(len(places)), rng.normal(0, 0.01, (FACTORS, len(places)))]).astype(np.float32)
    moved = np.full(model.shape, 1e-2, dtype=np.float32)
    shrink = np.array([[SHRINK]] + [[SHRINK_FACTORS]] * FACTORS, dtype=np.float32)
    # From here on the batches hold the terms instead of the rows.
    turn, batches = rng.permutation(len(rows)), []
    for low in range(0, len(turn), BATCH):
        mine = turn[low : low + BATCH]
        at, row = _flat([rows[i] for i in mine])
        by_place = np.argsort(at, kind="stable")
        here, start, place = np.unique(at[by_place], return_index=True, return_inverse=True)
        local = np.empty(len(at), dtype=np.int32)
        local[by_place] = place
        filled, first = np.unique(row, return_index=True)
        if len(here):
            batches.append((mine, here, local, row[by_place].astype(np.int16), start.astype(np.int32), filled, first))
            for i in mine:
                rows[i] = rows[i][:0]
    for _ in range(min(max(-(-STEPS // max(len(batches), 1)), EPOCHS[0]), EPOCHS[1])):
        for mine, here, local, row, start, filled, first in (batches[i] for i in rng.permutation(len(batches))):
            scale, old = much[here], model.take(here, axis=1)
            now = old * scale
            sums = np.zeros((FACTORS + 2, len(mine)))
            for k, each in enumerate([*now, (now[1:] ** 2).sum(0)]):
                sums[k, filled] = np.add.reduceat(each[local], first)
            raw = bias + sums[0] + 0.5 * ((sums[1:-1] ** 2).sum(0) - sums[-1])
            p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            slope = (p - y[mine]) * importance[mine]
            bias -= 0.02 * slope.mean()
            down = np.stack([np.add.reduceat(each[row], start) for each in np.vstack([slope, slope * sums[1:-1]]).astype(np.float32)])
            down[1:] -= now[1:] * down[0]
            g = down * scale / len(mine) + shrink * old
            grown = moved.take(here, axis=1) + g * g
            moved[:, here] = grown
            model[:, here] = old - RATE * g / np.sqrt(grown)
    model = (model * much).astype(float)
    return Machine(bias, places, model[0], model[1:].T.copy())


def fit(docs: DataFrame, labels: DataFrame, each: int = FIT_EACH) -> Machine:
    """Learns ``labels.toxic`` from the rows that are not held out."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [bounded_sample(known.where(F.col("label") == k), "doc_id", each) for k in (0, 1)]
    # At most about twice FIT_EACH ids and labels, whatever the size of the tables.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for batch in batches:
            found = [known.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.list_(pa.int32()))], names=["label", "terms"])

    found = rows.mapInArrow(run, "label int, terms array<int>").toArrow()
    y = found["label"].to_numpy().astype(float)
    # Copies, so that what Arrow holds can go before the fit.
    listed = [np.array(t.values, dtype=np.int32) for t in found["terms"]]
    del found
    # Each label weighs as much as in all labelled rows.
    there = [max((y == k).sum(), 1) for k in (0, 1)]
    total = sum(share.values()) or 1
    importance = np.where(y == 1, share.get(1, 0) / there[1], share.get(0, 0) / there[0]) * len(y) / total
    return fit_rows(listed, y, np.sqrt(importance), _on_executors(docs.sparkSession))


def assess(docs: DataFrame, model: Machine, column: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1."""
    kept = docs.drop("score")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(model.places)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = batch.column(batch.schema.get_field_index(column))
                score = model.score([known.of(t.as_py()) for t in texts])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    found = assess(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
