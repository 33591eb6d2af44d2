from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
import sentencepiece
from llm.test_jaccard import brute
from llm.test_mixing import water

from blockloom.llm import mixing, pieces
from blockloom.session import stage


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, [tuple(r) for r in docs.collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "exact_dedup", "ngram_jaccard", "mixing", "sentencepiece"]

    def after(name, df):
        out = stage(steps[name](spark, df, sf_dir), name)
        rows = [tuple(r) for r in out.collect()]
        if name != "sentencepiece":
            assert out.columns == columns
        return out, rows

    # All of these texts with letters are in the four languages; the others go.
    docs, rows = after("language_id", docs)
    assert sorted(rows) == sorted(r for r in before if any(c.isalpha() for c in r[1] or ""))

    before, first = rows, {}
    for r in sorted(before):
        first.setdefault(_normal(r[1]), r)
    docs, rows = after("exact_dedup", docs)
    assert sorted(rows) == sorted(first.values())

    before = rows
    heads = {d: c for d, _, c in brute(before, 5, (80, 100))}
    docs, rows = after("ngram_jaccard", docs)
    assert sorted(rows) == sorted(r for r in before if heads[(False, r[0])] == (False, r[0]))

    before = rows
    copies = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    docs, rows = after("mixing", docs)
    assert Counter(rows) == +Counter({r: copies[r[0]] for r in before})

    for r in before:
        assert 0 <= copies[r[0]] <= 3

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    docs, out = after("sentencepiece", docs)
    assert Counter(r[:5] for r in out) == Counter(rows)
    for r in out:
        assert r[5] == library.encode(r[1]) and r[6] == library.decode(r[5])


def test_run_gives_what_its_stages_should(spark, sf_dir):
    """The whole of it against loops that share no code with the operators, from the tables to the last stage."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    first = {}
    for r in sorted(rows):
        first.setdefault(_normal(r[1]), r)
    heads = {d: c for d, _, c in brute(list(first.values()), 5, (80, 100))}
    rows = [r for r in first.values() if heads[(False, r[0])] == (False, r[0])]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    target = water(sizes)
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    known, taken, times = {r[0]: r for r in rows}, Counter(), Counter()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for r in got:
        assert r[:5] == known[r[0]] and r[5] == library.encode(r[1]) and r[6] == library.decode(r[5])
        taken[r[3]] += len(r[1].split())
        times[r[0]] += 1
    assert max(times.values()) <= 3
    for source, size in sizes.items():
        largest = max(len((r[1] or "").split()) for r in rows if r[3] == source)
        assert abs(taken[source] - target[source]) <= largest
    # Where all of a source is wanted, all of it is there.
    full = {s for s in sizes if target[s] >= sizes[s]}
    assert {r[0] for r in rows if r[3] in full and r[1].split()} <= set(times)


def _normal(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_rows_go_through(spark, documents, awkward, crowded, empty):
    docs = crowded(documents([] if empty else awkward))
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, ""), name)
    assert empty == (docs.count() == 0)


def test_queries_are_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
