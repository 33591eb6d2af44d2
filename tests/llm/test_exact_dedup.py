from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from blockloom.llm import exact_dedup as E


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[normal(r[1])].append(r[0])
    return sorted(
        (order(r[0]), order(min(by[normal(r[1])], key=order)), len(by[normal(r[1])]), hashlib.sha256(normal(r[1]).encode()).hexdigest()) for r in rows
    )


def found(df):
    out = []
    for r in df.collect():
        out += [(order(r.doc_id), order(r.keep_id), r.group_size, r.text_sha256)] * r.rows
    return sorted(out)


@pytest.mark.parametrize("block", [4, 512])
def test_awkward_rows(documents, awkward, crowded, block):
    assert found(E.groups(crowded(documents(awkward)), block)) == expected(awkward)


def test_hashes_that_blocks_share(documents):
    rows = [(i, f"text {i % 7} of {i % 5} " * (1 + i % 4)) for i in range(60)]
    weak = lambda block: F.pmod(F.xxhash64(block), F.lit(3))
    assert found(E.groups(documents(rows), 8, weak)) == expected(rows)


def test_equal_blocks_in_other_order_differ(documents):
    rows = [(1, "aaaabbbbcccc"), (2, "bbbbaaaacccc"), (3, "aaaabbbb"), (4, "aaaa"), (5, "aaaabbbbcccc")]
    assert found(E.groups(documents(rows), 4)) == expected(rows)


def test_one_row_of_each_text_stays(documents, awkward, crowded):
    kept = E.deduplicate(crowded(documents(awkward)))
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(r[1]) for r in awkward})
    assert kept.columns == crowded(documents(awkward)).columns


def test_empty_table(documents):
    assert E.groups(documents([])).count() == 0
    assert E.deduplicate(documents([])).count() == 0


def test_no_python_in_the_plans(documents, awkward, monkeypatch):
    plans = []
    from blockloom.llm import exact_dedup

    stage = exact_dedup.stage

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(exact_dedup, "stage", watched)
    plans.append(E.groups(documents(awkward), 8)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not any(x in p for p in plans for x in ("Python", "Pandas", "Arrow"))
