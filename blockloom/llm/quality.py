"""Quality by a generalised additive model with pairwise interactions.

Every feature is cut into bins and owns a lookup table of one number per bin.
The tables are learned by cyclic boosting: round after round, each feature in
turn gets a shallow tree (a few cuts along its bins) fitted to the gradients
that are left, added with a small step. The pairs of features with most
gradient left then get two-dimensional tables in the same way. A score is the
sum of the numbers in a row's bins, for a whole batch at once.

The fit takes a bounded sample of labelled rows (``FIT_ROWS``), chosen by a
hash of the id; features of the sample are worked out in the tasks, and only
they reach the driver.

Nulls and ties: a null text counts as empty; both get the score of their
bins like any other text. Labels without a document, null labels and labels
of null ids are not learned from. Without labels every score is 0.5. Repeated
rows are scored alike; an empty table gives an empty result; other columns
pass through ``assess``, but for ``score``, which is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, held_out, table

#: Labelled rows that the fit reads at most.
FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 12
ROUNDS, PAIR_ROUNDS, STEP, CUTS = 120, 40, 0.15, 3
#: Least weight (sum of p * (1 - p)) on either side of a cut.
LEAST = 2.0
THRESHOLD = 0.3

UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SIGNS = b"#$%&*!|<>{}[]=+^~@_\\/"
STOPS = b".,;:?"

FEATURES = (
    "characters", "words", "word_length", "distinct", "commonest", "repeated", "upper", "signs", "digits",
    "stops", "lines", "line_length", "repeated_lines", "short_words", "sign_ends", "wide", "bars", "common_pair",
)


def features(text: str | None) -> tuple[float, ...]:
    text = text or ""
    raw = text.encode()
    words, lines = text.split(), text.split("\n")
    n, w = max(len(raw), 1), max(len(words), 1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    without = lambda kind: (n - len(raw.translate(None, kind))) / n if raw else 0.0
    return (
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / w,
        len(counts) / w,
        max(counts.values(), default=0) / w,
        sum(c for (a, b), c in pairs.items() if a == b) / w,
        without(UPPER),
        without(SIGNS),
        without(DIGITS),
        without(STOPS),
        len(lines) / w,
        np.log1p(len(text) / len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(c for x, c in counts.items() if len(x) < 4) / w,
        sum(c for x, c in counts.items() if not x[-1].isalnum() and x[-1] not in ".,;:?") / w,
        1 - len(text) / n if raw else 0.0,
        counts.get("|", 0) / w,
        max(pairs.values(), default=0) / w,
    )


@dataclass
class Additive:
    """Cut points of each feature, their tables, and the tables of pairs."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    start: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for i, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, i])]
        bins = {}
        for i, j, values in self.pairs:
            for k in (i, j):
                if k not in bins:
                    bins[k] = np.searchsorted(self.pair_edges[k], x[:, k])
            out += values[bins[i], bins[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-self.raw(x))), 9)


def _quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, cuts: int = CUTS) -> np.ndarray:
    """One value per bin: a tree of at most ``cuts`` cuts along the bins, each
    the one of most gain."""
    g, h = np.concatenate([[0], gradient.cumsum()]), np.concatenate([[0], weight.cumsum()])
    parts = [(0, len(gradient))]
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    for _ in range(cuts):
        best = (1e-9, None, None)
        for part in parts:
            low, high = part
            at = np.arange(low + 1, high)
            at = at[(h[at] - h[low] >= LEAST) & (h[high] - h[at] >= LEAST)]
            if len(at):
                gain = worth(low, at) + worth(at, high) - worth(low, high)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], part, int(at[k]))
        if best[1] is None:
            break
        low, high = best[1]
        parts.remove(best[1])
        parts += [(low, best[2]), (best[2], high)]
    out = np.zeros(len(gradient))
    for low, high in parts:
        out[low:high] = (g[high] - g[low]) / (h[high] - h[low] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Of all ways to cut both features once, the one of most gain, as a table."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    left_g, top_g, all_g = cg[-1:, :], cg[:, -1:], cg[-1, -1]
    left_h, top_h, all_h = ch[-1:, :], ch[:, -1:], ch[-1, -1]
    quarter = [(cg, ch), (top_g - cg, top_h - ch), (left_g - cg, left_h - ch), (all_g - top_g - left_g + cg, all_h - top_h - left_h + ch)]
    gain = sum(a * a / (b + 1.0) for a, b in quarter)[:-1, :-1]
    if gain.size == 0:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = [a[i, j] / (b[i, j] + 1.0) for a, b in quarter]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j] - all_g * all_g / (all_h + 1.0)), out


def fit_table(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of feature rows ``x`` and labels ``y``, the same whatever the order of rows."""
    if not len(y):
        return Additive()
    order = np.lexsort([*x.T[::-1], y])
    x, y = x[order], y[order]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Additive(start=float(np.log(rate / (1 - rate))))
    model.edges = [_quantiles(c, BINS) for c in x.T]
    model.pair_edges = [_quantiles(c, PAIR_BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, c) for e, c in zip(model.edges, x.T)]
    raw = np.full(len(y), model.start)
    for _ in range(ROUNDS):
        for k, at in enumerate(bins):
            p = 1 / (1 + np.exp(-raw))
            size = len(model.tables[k])
            step = STEP * shallow_tree(np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size))
            model.tables[k] += step
            raw += step[at]
    wide = [np.searchsorted(e, c) for e, c in zip(model.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = wide[i] * sizes[j] + wide[j]
        p = 1 / (1 + np.exp(-raw))
        count = sizes[i] * sizes[j]
        shape = (sizes[i], sizes[j])
        return at, np.bincount(at, y - p, count).reshape(shape), np.bincount(at, p * (1 - p), count).reshape(shape)

    gains = [(-_quadrants(*grid(i, j)[1:])[0], i, j) for i in range(len(wide)) for j in range(i)]
    chosen = [(i, j) for gain, i, j in sorted(gains)[:PAIRS] if gain < -1e-9]
    tables = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            at, g, h = grid(i, j)
            step = STEP * _quadrants(g, h)[1]
            tables[i, j] += step
            raw += step.ravel()[at]
    model.pairs = [(i, j, v) for (i, j), v in tables.items()]
    return model


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index(column))
    return np.array([features(t.as_py()) for t in texts], dtype=np.float64).reshape(batch.num_rows, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Additive:
    """Learns ``labels.quality`` from the rows that are not held out."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    known = bounded_sample(known, "doc_id", most)
    # At most about FIT_ROWS ids and labels, whatever the size of the tables.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, "text")
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["label", "x"])

    found = rows.mapInArrow(run, "label double, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist(), dtype=np.float64).reshape(found.num_rows, len(FEATURES))
    return fit_table(x, found["label"].to_numpy())


def assess(docs: DataFrame, model: Additive, column: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1."""
    kept = docs.drop("score")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.score(_rows(batch, column)))], names=[*batch.schema.names, "score"]
            )

    return kept.mapInArrow(run, schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    found = assess(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
