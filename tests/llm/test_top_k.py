from __future__ import annotations

import math

import duckdb
import numpy as np
from compare import difference, duck

from blockloom.llm import top_k as K
from blockloom.llm.queries import ORACLES, QUERIES


def brute(rows, asked, k):
    """Every pair of rows of different ids; queries of one id share a list."""
    known = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for q in {i for i, _ in known if asked(i)}:
        best = sorted((-score(w, v), i) for j, w in known if j == q for i, v in known if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def found(spark, rows, asked, **more):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    whole = K.whole_numbers(df)
    return sorted(map(tuple, K.top_k(whole, whole.where(asked), **more).collect()))


def test_clusters_and_ties(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.05 * rng.normal(size=8)).astype("float32").tolist()) for i in range(600)]
    rows += [(600 + i, [0.5] * 8) for i in range(40)]
    got = found(spark, rows, "vec_id % 10 = 0", part_queries=7, part_vectors=50)
    assert got == brute(rows, lambda i: i % 10 == 0, 5)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, []), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [-3.0, 0.1])]
    assert found(spark, rows, "vec_id % 50 = 0") == brute(rows, lambda i: i % 50 == 0, 5)
    assert found(spark, [], "true") == []
    assert found(spark, [(0, [1.0])], "true") == []


def test_repeated_ids(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 1.0]), (3, [0.5, 4.0]), (4, [-1.0, 0.0])]
    got = found(spark, rows, "vec_id % 50 = 0")
    assert got == brute(rows, lambda i: i % 50 == 0, 5)
    assert got[0] == (0, 1, 1, 196608)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.sql(ORACLES["op3_top_k"]).fetchall()) == got


def test_few_pivots_and_parts_give_the_same(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).astype("float32").tolist()) for i in range(500)]
    want = brute(rows, lambda i: i % 5 == 0, 5)
    for pivots, queries, vectors in ((1, 7, 30), (3, 1000, 50), (2048, 512, 8192)):
        assert found(spark, rows, "vec_id % 5 = 0", pivots=pivots, part_queries=queries, part_vectors=vectors) == want


def test_few_vectors_are_sent(spark, sf_dir):
    """A cell for each query sends little more than the answers, and so do shared cells of queries in clusters."""
    rng = np.random.default_rng(6)
    centres = 5 * rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.05 * rng.normal(size=16)).astype("float32").tolist()) for i in range(4000)]
    clusters = K.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    # 400 queries in 40 cells: at most a cluster's 200 vectors for each of its cells.
    made = K.dealt(clusters, clusters.where("vec_id % 10 < 1"), pivots=40)
    assert made.sent.count() <= 0.06 * 4000 * (made.count > 0).sum()
    given = K.whole_numbers(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    n, asked = given.count(), given.where("vec_id % 50 = 0")
    assert K.dealt(given, asked).sent.count() <= 0.05 * n * asked.count()


def test_rounds_give_the_same(spark):
    """More queries than a round has; those of one id may be in different rounds."""
    rng = np.random.default_rng(7)
    rows = [(i % 260, rng.normal(size=6).astype("float32").tolist()) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 340)]
    want = brute(rows, lambda i: i % 4 == 0, 5)
    for asked, pivots in ((40, 40), (30, 7)):
        assert found(spark, rows, "vec_id % 4 = 0", round_queries=asked, pivots=pivots) == want


def test_a_vector_is_sent_for_a_query_not_for_all_of_its_cell(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype("float32").tolist()) for i in range(4000)]
    whole = K.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    # Five queries a cell, unlike each other, so that no cell's limit excludes much.
    assert K.dealt(whole, whole.where("vec_id % 40 = 0"), pivots=20).sent.count() <= 20 * 4000 / 8


def test_vectors_of_one_score_are_not_all_sent(spark):
    """What a task makes of a number of vectors is bounded by k for each query, not by all pairs."""
    rows = [(i, [float(i % 100 == 0 and i // 100 == c) for c in range(40)] + [1.0]) for i in range(4000)]
    whole = K.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    made = K.dealt(whole.coalesce(1), whole.where("vec_id % 100 = 0"))
    assert (made.count > 0).sum() == 40
    assert made.sent.count() <= 40 * 5 * (4000 // K.TOGETHER + 8)


def test_oracle(spark, sf_dir):
    assert difference(spark, duck(sf_dir), QUERIES["op3_top_k"], ORACLES["op3_top_k"], sf_dir) is None
