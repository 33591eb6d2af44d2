"""Exact top-k search as a Voronoi kNN join.

Some of the queries, the pivots, divide the space into cells: a vector, query
or not, belongs to the pivot nearest to it. Up to ``PIVOTS`` queries have a
cell each; more share cells. Summaries say what can matter where: the k + 1
members nearest to each pivot give every query a score that its k-th answer
reaches for certain, and the mean and radius of a cell's queries limit what a
data vector can score there, mean.v + radius |v|. Cells whose least certain
score that limit does not reach are passed over, nearly all mostly; to the others
a vector is sent if it reaches the certain score of one of their queries, and is
among the k best for it of the vectors that are looked at together. Cells are
solved on their own in bounded parts, and each query's partial answers are merged.

More queries than there are pivots are dealt in rounds, so that each has a cell
whatever their number, and no task holds more than a round's queries. A round
reads the vectors twice; queries are a share of the vectors here, so the work
grows with the square of the table, as pairs do. How many vectors are sent
depends on the data, little more than the answers mostly, and at most k for each
query from every ``TOGETHER`` vectors.

Nulls and ties: vectors that are null or hold null, NaN or infinite
components, and rows without an id, take no part. Equal scores go to the
smaller id. Shorter vectors count as filled up with zeros. Rows that repeat an
id are candidates each; they are no answer to each other, and queries of one
id share one list of answers. With fewer candidates than k all are returned;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, unstage
from .common import table

K = 5
#: Cells at most; the summaries have a vector for each.
PIVOTS = 2048
#: Queries of a round on average, as a share of the most: so few that the hash
#: that deals them out gives no round more.
FILLED = 5 / 6
#: Vectors that are looked at together when they are sent.
TOGETHER = 1000
#: The certain score of a query with fewer than k vectors near pivots.
NONE = np.iinfo(np.int64).min
#: Queries of a part of a cell, parts and data vectors that are solved together.
QUERIES, PARTS, VECTORS = 512, 64, 8192


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.select("vec_id", v.alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out, sizes = np.zeros((len(column), width), dtype=np.int64), column.value_lengths().to_numpy()
    values = column.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(-1, width) if width else out
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _scores(a: np.ndarray, b: np.ndarray, exact_float: bool) -> np.ndarray:
    if exact_float:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row, ties to the smaller id."""
    if score.shape[1] > 4 * k:
        # Everything that reaches the k-th score, then sorted.
        limit = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
        return np.array([(w := np.flatnonzero(row >= least))[np.lexsort((ids[w], -row[w]))][:k] for row, least in zip(score, limit)])
    return np.array([np.lexsort((ids, -row))[:k] for row in score]).reshape(len(score), -1)


def _mattering(score: np.ndarray, ids: np.ndarray, asked: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """Which rows (of vectors ``ids``) reach the certain score of a column (of
    queries ``asked``) and are among its k best."""
    keep = (score >= sure) & (ids[:, None] != asked)
    for column in np.flatnonzero(keep.sum(0) > k):
        rows = np.flatnonzero(keep[:, column])
        keep[np.delete(rows, _best(score[rows, column][None, :], ids[rows], k)[0]), column] = False
    return keep.any(1)


@dataclass(frozen=True)
class Dealt:
    """Queries (vec_id, v, cell), the vectors sent to cells (the same columns),
    and how many queries each cell has."""

    asked: DataFrame
    sent: DataFrame
    count: np.ndarray
    width: int
    exact_float: bool


def dealt(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS) -> Dealt | None:
    """Groups both sides by pivots and sends each vector where it can matter;
    all queries are one round's."""
    data = stage(vectors.select("vec_id", "v"), "vectors")
    made = _dealt(data, _asked(data, queries), _shape(data), k, pivots)
    unstage(data)
    return made


def _asked(data: DataFrame, queries: DataFrame) -> DataFrame:
    return data.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")


def _shape(data: DataFrame) -> tuple[int, bool]:
    """Components of the longest vector, and whether floats hold every score exactly."""
    shape = data.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    width, most = shape[0] or 0, shape[1] or 0
    return width, most * most * max(width, 1) < 1 << 53


def _dealt(data: DataFrame, asked: DataFrame, shape: tuple[int, bool], k: int, pivots: int) -> Dealt | None:
    width, exact_float = shape
    # PIVOTS vectors, whatever the size of the table.
    chosen = asked.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).select("v").toArrow()
    p = chosen.num_rows
    if not p:
        return None
    centre = _matrix(chosen["v"], width).astype(np.float64)
    square = (centre * centre).sum(1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                m = _matrix(batch.column(1), width).astype(np.float64)
                d = (m * m).sum(1)[:, None] - 2 * m @ centre.T + square
                cell = d.argmin(1)
                away = np.sqrt(np.maximum(d[np.arange(len(m)), cell], 0))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=["vec_id", "v", "cell", "away"])

    cells = "vec_id long, v array<long>, cell int, away double"
    asked = stage(asked.mapInArrow(placed, cells).select("vec_id", "v", "cell"), "queries")
    near = data.mapInArrow(placed, cells).withColumn("_r", F.row_number().over(Window.partitionBy("cell").orderBy("away", "vec_id"))).where(F.col("_r") <= k + 1)
    near = near.select("vec_id", "v").toArrow()  # k + 1 for each pivot
    near_ids, near_v = near["vec_id"].to_numpy(), _matrix(near["v"], width)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per cell the number and the sum of its queries."""
        for batch in batches:
            m, (cells, place) = _matrix(batch.column(1), width).astype(np.float64), np.unique(batch.column(2).to_numpy(), return_inverse=True)
            sums = np.zeros((len(cells), width))
            np.add.at(sums, place, m)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(np.bincount(place), pa.int64()), pa.array(sums.tolist(), pa.list_(pa.float64()))], names=["cell", "n", "v"])

    sums = asked.mapInArrow(added, "cell int, n long, v array<double>")
    count, mean = np.zeros(p, dtype=np.int64), np.zeros((p, width))
    for cell, n in sums.groupBy("cell").agg(F.sum("n")).collect():
        count[cell] = n
    each = sums.select("cell", F.posexplode("v").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x")).toArrow()
    mean[each["cell"].to_numpy(), each["at"].to_numpy()] = each["x"].to_numpy()
    mean /= np.maximum(count, 1)[:, None]

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per query its certain score and how far it is from the mean."""
        for whole in batches:
            for start in range(0, whole.num_rows, 125):
                batch = whole.slice(start, 125)
                ids, m, cell = batch.column(0).to_numpy(), _matrix(batch.column(1), width), batch.column(2).to_numpy()
                score = _scores(m, near_v, exact_float)
                score[ids[:, None] == near_ids] = NONE
                sure = np.partition(score, score.shape[1] - k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(m), NONE)
                away = np.sqrt(((m - mean[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sure), pa.array(away)], names=["vec_id", "v", "cell", "sure", "away"])

    # The different queries of a round.
    each = asked.dropDuplicates(["vec_id", "v"]).mapInArrow(limits, "vec_id long, v array<long>, cell int, sure long, away double").toArrow().sort_by("cell")
    asked_ids, asked_v, asked_cell = each["vec_id"].to_numpy(), _matrix(each["v"], width), each["cell"].to_numpy()
    asked_sure, least, radius = each["sure"].to_numpy(), np.full(p, np.inf), np.zeros(p)
    np.minimum.at(least, asked_cell, np.where(asked_sure == NONE, -np.inf, asked_sure.astype(np.float64)))
    np.maximum.at(radius, asked_cell, each["away"].to_numpy())
    first = np.searchsorted(asked_cell, np.arange(p + 1))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A data vector once for each cell of queries that it can matter to."""
        for whole in batches:
            for start in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(start, TOGETHER)
                ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
                m = v.astype(np.float64)
                reach = m @ mean.T + np.sqrt((m * m).sum(1))[:, None] * radius
                # A margin far above the rounding of the bounds.
                cell, at = np.nonzero(((reach + 1e-6 * np.abs(reach) + 1e-3 >= least) & (count > 0)).T)
                cells, begin = np.unique(cell, return_index=True)
                rows = []
                for c, some in zip(cells, np.split(at, begin[1:])):
                    mine = slice(first[c], first[c + 1])
                    score = _scores(v[some], asked_v[mine], exact_float)
                    rows.append(some[_mattering(score, ids[some], asked_ids[mine], asked_sure[mine], k)])
                if not rows:
                    continue
                took = pa.RecordBatch.from_arrays(batch.columns[:2], names=["vec_id", "v"]).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array(np.repeat(cells, [len(r) for r in rows]).astype(np.int32))], names=["vec_id", "v", "cell"])

    sent = stage(data.mapInArrow(needed, "vec_id long, v array<long>, cell int"), "sent")
    return Dealt(asked, sent, count, width, exact_float)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    pivots: int = PIVOTS,
    part_queries: int = QUERIES,
    part_vectors: int = VECTORS,
    round_queries: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score); both sides are (vec_id, v)."""
    data = stage(vectors.select("vec_id", "v"), "vectors")
    asked, shape = stage(_asked(data, queries), "asked"), _shape(data)
    n = asked.distinct().count()
    rounds = 1 if n <= round_queries else math.ceil(n / (FILLED * round_queries))
    found = []
    for number in range(rounds):
        mine = asked.where(F.pmod(F.xxhash64(F.lit(7), "vec_id", "v"), F.lit(rounds)) == number)
        made = _dealt(data, mine, shape, k, pivots)
        if made is None:
            continue
        answers = _ranked(_solved(made, k, part_queries, part_vectors), k)
        if rounds > 1:  # A round's answers are few; what it sent goes before the next one.
            answers = stage(answers, "answers")
            unstage(made.sent)
            unstage(made.asked)
        found.append(answers)
    unstage(data)
    unstage(asked)
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Queries of one id may be in different rounds.
    return found[0] if len(found) == 1 else _ranked(reduce(DataFrame.unionByName, found), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _solved(made: Dealt, k: int, part_queries: int, part_vectors: int) -> DataFrame:
    """(query_id, vec_id, score): the best of every part, bounded numbers of queries and vectors at a time."""
    width, exact_float = made.width, made.exact_float
    # A cell has parts of a bounded number of queries; some parts, numbered on, are solved together.
    parts = np.maximum(-(-made.count // part_queries), 1)
    first = np.concatenate([[0], np.cumsum(parts)])
    arrivals = np.zeros(-(-int(first[-1]) // PARTS), dtype=np.int64)
    for cell, n in made.sent.groupBy("cell").agg(F.count(F.lit(1))).collect():
        for number in range(int(first[cell]) // PARTS, (int(first[cell + 1]) - 1) // PARTS + 1):
            arrivals[number] += n
    chunks = np.maximum(-(-arrivals // part_vectors), 1).tolist()
    spark = made.sent.sparkSession
    numbers = [(c, int(first[c]) + t, (int(first[c]) + t) // PARTS, chunks[(int(first[c]) + t) // PARTS]) for c in range(len(parts)) for t in range(int(parts[c]))]
    # A row per part: as many as cells and as parts of QUERIES queries.
    places = spark.createDataFrame(numbers, "cell int, unit int, bunch int, chunks int")
    part = F.col("unit") - F.min("unit").over(Window.partitionBy("cell"))
    places = places.withColumn("part", part).withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy("cell")))
    chunk = F.pmod(F.xxhash64(F.lit(3), "vec_id", "v"), F.col("chunks")).cast("int")
    sent = made.sent.join(places, "cell").select("vec_id", "v", "unit", "bunch", chunk.alias("chunk"))
    mine = F.pmod(F.xxhash64(F.lit(5), "vec_id", "v"), F.col("parts")) == F.col("part")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    asked = made.asked.join(places, "cell").where(mine).select("vec_id", "v", F.col("unit").alias("unit"), F.col("bunch").alias("bunch"), every)

    def solved(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            at, units = left["unit"].to_numpy(), right["unit"].to_numpy()
            turn, order = np.argsort(at, kind="stable"), np.argsort(units, kind="stable")
            q, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            asked_m, data_m = _matrix(left["v"], width), _matrix(right["v"], width)
            for unit in np.unique(at):
                theirs = order[np.searchsorted(units, unit, sorter=order) : np.searchsorted(units, unit, "right", sorter=order)]
                ours = turn[np.searchsorted(at, unit, sorter=turn) : np.searchsorted(at, unit, "right", sorter=turn)]
                for start in range(0, len(ours), 64):
                    some = ours[start : start + 64]
                    for i, row in zip(some, _scores(asked_m[some], data_m[theirs], exact_float)):
                        other = np.flatnonzero(ids[theirs] != q[i])
                        best = other[_best(row[other][None, :], ids[theirs[other]], k)[0]] if len(other) else other
                        found.append((np.full(len(best), q[i]), ids[theirs[best]], row[best]))
        columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else ([], [], []))]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    key = ["bunch", "chunk"]
    return asked.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(solved, "query_id long, vec_id long, score long")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP3_SQL = """
with w as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v
  from embeddings where embedding is not null and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)),
s as (
  select q.vec_id as query_id, d.vec_id, cast(list_dot_product(q.v, d.v) as bigint) as score
  from w q join w d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""
