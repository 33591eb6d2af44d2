from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from blockloom.llm import merkle as M
from blockloom.llm.queries import ORACLES, QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, row.text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    """(run without the node, place in it) level by level."""
    for level in tree[:-1]:
        first = i // 8 * 8
        run = level[first : first + 8]
        yield run[: i - first] + run[i - first + 1 :], i - first
        i //= 8


def expected(rows):
    """One row per document, each proof on its own."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r)
    langs = sorted(by_lang, key=lambda s: (s is not None, (s or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, leaf(r)))
    trees = {lang: levels([leaf(r) for r in by_lang[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    for lang in langs:
        for i, r in enumerate(by_lang[lang]):
            steps = [*path(trees[lang], i), *path(top, langs.index(lang))]
            value = leaf(r)
            for others, at in steps:
                value = h(*others[:at], value, *others[at:])
            assert value == top[-1][0]
            yield r.doc_id, leaf(r), trees[lang][-1][0], top[-1][0], h(*itertools.chain(*[s for s, _ in steps]))


def small(monkeypatch, depth):
    monkeypatch.setattr(M, "DEPTH", depth)
    monkeypatch.setattr(M, "BLOCK", M.ARITY**depth)


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_proofs_equal_those_made_one_by_one(documents, monkeypatch, depth):
    small(monkeypatch, depth)
    sizes = {"en": 700, None: 65, "de": 64, "fr": 9, "it": 8, "Ω": 1, "": 2, "z": 1, "y": 1, "x": 513}
    rows = [(i, f"text {i}\nÄ" * (i % 5), lang, "s" if i % 3 else None) for i, lang in enumerate(itertools.chain(*[[k] * n for k, n in sizes.items()]))]
    random.Random(3).shuffle(rows)
    docs = documents(rows)
    got = M.proved(M.manifest(docs)).collect()
    assert {(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got} == set(expected(docs.collect()))
    assert len(got) == len(rows) and all(r.verified and r.folded_root == r.root for r in got)


def test_awkward_rows(documents, awkward, crowded):
    docs = crowded(documents(awkward))
    got = M.proved(M.manifest(docs)).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == Counter(expected(docs.collect()))
    none = M.manifest(crowded(documents([])))
    assert none.root is None and M.proved(none).count() == 0


def test_changed_rows_do_not_verify(documents):
    docs = documents([(i, f"Text {i}", "en" if i % 7 else "de", None) for i in range(300)])
    claimed = F.when(F.col("doc_id") % 10 == 0, M.leaf([F.lower(c) if c == "text" else F.col(c) for c in M.COLUMNS]))
    got = M.proved(M.manifest(docs, claimed=claimed)).collect()
    assert len(got) == 300 and all(r.verified == (r.doc_id % 10 != 0) for r in got)


def test_some_rows_are_proved_with_few_nodes(documents):
    docs = documents([(i, f"text {i}", "en" if i % 9 else None) for i in range(5000)])
    made = M.manifest(docs)
    asked = made.leaves.where(F.col("doc_id").isin(0, 5, 6, 7, 4099, 4321))
    got = {r.doc_id: r for r in M.proved(made, asked, with_proofs=True).collect()}
    want = {r[0]: r for r in expected(docs.collect())}
    assert set(got) == {0, 5, 6, 7, 4099, 4321}
    for i, r in got.items():
        assert r.verified and r.proof_sha256 == want[i][4] == h(*r.proof)


def test_the_coordinates_are_the_fewest():
    rng = random.Random(1)
    for n in (1, 2, 8, 9, 63, 64, 65, 600):
        for some in (1, 2, 7, n):
            known = sorted(rng.sample(range(n), min(some, n)))
            found = M.missing(known, n)
            assert len(set(found)) == len(found)
            # Every one is needed: it is beside a node that leaves give, and none of the leaves lies below it.
            for level, i in found:
                assert all(k // 8**level != i for k in known) and any(k // 8 ** (level + 1) == i // 8 for k in known)
            # They are enough: the root can be derived.
            level, now, count = 0, set(known), n
            while count > 1:
                have = now | {i for at, i in found if at == level}
                parents = {i // 8 for i in now}
                assert all(i in have for p in parents for i in range(8 * p, min(8 * p + 8, count)))
                now, count, level = parents, -(-count // 8), level + 1
    assert M.missing(list(range(600)), 600) == []


def test_the_query_equals_its_sql(spark, sf_dir):
    assert difference(spark, duck(sf_dir), QUERIES["op12_merkle"], ORACLES["op12_merkle"], sf_dir) is None
