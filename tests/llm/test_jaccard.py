from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from blockloom.llm import jaccard as J
from blockloom.llm.graph import components


def brute(rows, words, least):
    """(doc_id, n, smallest id linked) of rows with distinct ids, by inverted lists."""
    sets, lists, parent = [], defaultdict(list), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, r in enumerate(rows):
        w = (r[1] or "").encode().lower().split()
        s = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets.append(s)
        common = defaultdict(int)
        for g in s:
            for j in lists[g]:
                common[j] += 1
            lists[g].append(i)
        for j, n in common.items():
            if least[1] * n >= least[0] * (len(s) + len(sets[j]) - n) and top(i) != top(j):
                parent[top(i)] = top(j)
    order = lambda d: (d is None, d or 0)
    smallest = {}
    for i, r in enumerate(rows):
        t = top(i)
        if t not in smallest or order(r[0]) < order(smallest[t]):
            smallest[t] = r[0]
    return sorted([(order(r[0]), len(sets[i]), order(smallest[top(i)])) for i, r in enumerate(rows)])


def found(df, words, least, block=J.BLOCK):
    order = lambda d: (d is None, d or 0)
    return sorted((order(r.doc_id), r.n, order(r.component_id)) for r in J.join(df, words, least, block).collect())


def near_copies(groups, members, length, seed=1):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(300)}" for _ in range(length)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(length)] = f"w{rng.randrange(300)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "least", "block"), [(3, (90, 100), 256), (5, (80, 100), 4)])
def test_near_copies(documents, words, least, block):
    rows = near_copies(6, 25, 90) + [(1000 + i, f"single text number {i} of no other kind") for i in range(30)]
    assert found(documents(rows), words, least, block) == brute(rows, words, least)


def test_shared_passage_links_nothing_by_itself(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"d{i}x{k}" for k in range(40 + i % 30)) + " " + passage) for i in range(120)]
    assert found(documents(rows), 3, (90, 100)) == brute(rows, 3, (90, 100))


def test_whole_table(spark, sf_dir):
    from blockloom.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(((False, r.doc_id), r.n_shingles, (False, r.component_id)) for r in QUERIES["op1_ngram_jaccard"](spark, sf_dir).collect())
    assert got == brute(rows, 3, (90, 100))


def test_awkward_rows(documents, awkward, crowded):
    df = crowded(documents(awkward))
    got = J.join(df, 3, (90, 100)).collect()
    assert len(got) == len(awkward)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    assert all(r.n == 0 and r.component_id == r.doc_id for r in got if r.doc_id in (4, 5, 6))
    kept = J.representatives(df, 3, (90, 100))
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (r[0] or 0, r[1] or "") for i, r in enumerate(awkward) if r[0] not in (2, 3) and awkward.index(r) == i
    )
    assert J.join(documents([]), 3, (90, 100)).count() == 0


def test_tree_loses_no_pair():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 1 << 62, rng.integers(5, 400)).astype(np.uint64)) for _ in range(40)]
    sets = []
    for b in base:
        for _ in range(6):
            keep = b[rng.random(len(b)) > rng.random() * 0.1]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, 2).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    for least in ((90, 100), (80, 100)):
        a, b = J.possible_pairs(sizes, [J.bitmap(s) for s in sets], least)
        pairs = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
        for i in range(len(sets)):
            for j in range(i):
                if J.similar(sets[i], sets[j], least):
                    assert (j, i) in pairs
        assert len(pairs) < len(sets) * 8


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 100L, 101L")).union(spark.sql("select 7L, 7L"))
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_sizes_that_may_be_similar_meet_in_blocks(spark):
    rng = np.random.default_rng(8)
    sizes = [int(n) for n in rng.integers(1, 120, 150)] + [9, 10, 90, 100, 81, 72, 80, 64, 1, 1]
    members = spark.createDataFrame([(7, len(sizes), i, n) for i, n in enumerate(sizes)] + [(8, 2, 0, 5), (8, 2, 1, 500)], "token long, sets long, node long, n long")
    for least in ((90, 100), (80, 100), (100, 100)):
        groups = {}
        for r in J._by_size(members, least, block=8).collect():
            groups.setdefault((r.token, r.part, r.over, r.i, r.j), []).append((r.node, r.n))
        assert all(len({x for x, _ in g}) == len(g) for g in groups.values())
        met = {(a, b) for (token, *_), g in groups.items() for a, _ in g for b, _ in g if token == 7}
        for a, n in enumerate(sizes):
            for b, m in enumerate(sizes):
                if 100 * min(n, m) >= least[0] * max(n, m):
                    assert (a, b) in met
        assert sorted(x for (token, *_), g in groups.items() for x, _ in g if token == 8) == [0, 1]


def test_a_token_of_many_sets_moves_few_of_them_often(spark):
    """20,000 sets share a token; blocks of sizes too far apart to be similar never meet."""
    members = spark.range(20_000).selectExpr("7L as token", "20000L as sets", "id as node", "20 + pmod(xxhash64(id), 2000) as n")
    moved = J._by_size(members, (90, 100)).count()
    assert moved < 0.35 * 20_000 * (20_000 / J.BLOCK)


def test_rows_without_an_id_meet_their_own_text_alone(documents):
    rows = [(None, f"row {i} without an id but with words of its own {i * i}") for i in range(300)] + [(None, "row 5 without an id but with words of its own 25")] * 3
    got = J.join(documents(rows), 3, (90, 100)).collect()
    assert len(got) == 303 and all(r.component_id is None for r in got)
    made = {}
    for r in got:
        made.setdefault((r.component_n, r.component_sum_a, r.component_sum_b), []).append(r)
    assert sorted(len(x) for x in made.values()) == [1] * 299 + [4]
