from __future__ import annotations

from collections import Counter, defaultdict

from blockloom.llm import mixing as M


def plan(df):
    return [r.asDict() for r in M.plan(df).collect()]


def water(sizes):
    """Targets by resharing until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        rest, w = total - sum(target.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / w >= 3 * sizes[s]]
        if not over:
            target |= {s: rest * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.discard(s)
    return target


def test_targets_and_taken_words(documents):
    rows = [(i, "w " * (1 + i * i % 97), None, "abcdefg"[i % 7] if i % 11 else None) for i in range(900)]
    rows += [(1000 + i, "w " * 3000, None, "z") for i in range(20)]
    got = plan(documents(rows))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    want = water(sizes)
    largest = defaultdict(int)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_hot_source_and_reruns(documents):
    rows = [(i, "a b c", None, "hot" if i % 10 else f"s{i % 3}") for i in range(500)]
    a, b = plan(documents(rows)), plan(documents(rows[::-1]).repartition(5))
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_awkward_rows(documents, awkward, crowded):
    df = crowded(documents(awkward))
    got = plan(df)
    assert len(got) == len(awkward)
    assert Counter(r["size"] for r in got) == Counter(len((r[1] or "").split()) for r in awkward)
    out = M.mix(df)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in got)


def test_repeated_rows_are_taken_as_often_as_planned(documents):
    rows = [(1, "a b", None, "s")] * 7 + [(2, "c d e", None, "s"), (3, "f", None, "t")]
    got = plan(documents(rows))
    out = Counter(r.doc_id for r in M.mix(documents(rows)).collect())
    want = Counter()
    for r in got:
        want[r["doc_id"]] += r["copies"]
    assert out == +want


def test_empty_table_and_texts(documents):
    assert M.plan(documents([])).count() == 0 and M.mix(documents([])).count() == 0
    assert [r["taken"] for r in plan(documents([(1, ""), (2, None)]))] == [0, 0]
