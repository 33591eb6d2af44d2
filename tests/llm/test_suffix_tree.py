from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from blockloom.llm import suffix_tree as M
from blockloom.llm.queries import QUERIES

LEARN = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 10 <> 0, false)"


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def expected(rows, depth, least, price):
    """The tree in dictionaries of word tuples, place after place."""
    count, follow = Counter(), defaultdict(Counter)
    for i, text in rows:
        if learned(i):
            words = ("<start>", *tokens(text))
            count.update(words[1:])
            for t in range(1, len(words)):
                for k in range(1, min(depth, t) + 1):
                    follow[words[t - k : t]][words[t]] += 1
    total, known = sum(count.values()), len(count)
    base = lambda w: (count[w] + 0.1) / (total + 0.1 * (known + 1))
    kept = {}

    def chance(context, w):
        for k in range(len(context), 0, -1):
            s = context[-k:]
            if s in kept:
                share, left = kept[s]
                return share.get(w, 0) + left * chance(s[1:], w)
        return base(w)

    for k in range(1, depth + 1):
        for s in [s for s in follow if len(s) == k]:
            n = sum(follow[s].values())
            if n < least:
                continue
            share = {w: (c - 0.5) / (n + 20) for w, c in follow[s].items() if c >= 2}
            left = max(1 - sum(share.values()), 1e-12)
            before = {w: chance(s[1:], w) for w in share}
            told = sum(x * math.log(x / before[w]) for w, x in share.items())
            told = n * (told + left * math.log(left / max(1 - sum(before.values()), 1e-12)))
            if share and told > price * (len(share) + 1):
                kept[s] = share, left
    for s in [(), *list(kept)[:20]]:
        assert sum(chance(s, w) for w in [*count, "\n unknown"]) == pytest.approx(1)
    for i, text in rows:
        words = ("<start>", *tokens(text))
        score = sum(math.log10(chance(words[max(t - depth, 0) : t], words[t])) for t in range(1, len(words)))
        yield i, not learned(i), len(words) - 1, sum(count[w] > 0 for w in words[1:]), total, sum(math.log10(base(w)) for w in words[1:]), score, len(kept)


def compare(rows, docs, depth, least, price):
    got = M.scored(docs, F.expr(LEARN), depth, least, price).collect()
    want = list(expected(rows, depth, least, price))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5], r[6])
    got = sorted([(r.doc_id, not r.learned, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    want = sorted(want, key=key)
    assert len(got) == len(want) and [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)
    return want[0][-1] if want else 0


@pytest.mark.parametrize("batch, bucket", [(2_000_000, 2_000_000), (150, 40)])
def test_scores_equal_those_of_a_tree_in_dictionaries(documents, monkeypatch, batch, bucket):
    monkeypatch.setattr(M, "BATCH", batch)
    monkeypatch.setattr(M, "BUCKET", bucket)
    rng = random.Random(5)
    after = {w: rng.choices("abcdefgh", k=3) for w in "abcdefgh"}
    rows = []
    for i in range(260):
        words = [rng.choice("abcdefgh")]
        while len(words) < rng.randrange(2, 40):
            words.append(rng.choice(after.get(words[-1], "abc")) if rng.random() < 0.8 else rng.choice(["a", "b", "Q", f"w{rng.randrange(300)}"]))
        rows.append((i, "\t ".join(words)))
    rows += [(1000 + i, "the same passage that stands in many texts again and again") for i in range(30)]
    for depth, least, price in ((1, 5, 0.5), (3, 5, 0.5), (3, 20, 3.0)):
        kept = compare(rows, documents(rows), depth, least, price)
        assert kept > 3
    # Longer contexts are there and the test leaves some out.
    assert compare(rows, documents(rows), 3, 5, 0.0) > compare(rows, documents(rows), 3, 5, 2.0) > compare(rows, documents(rows), 1, 5, 2.0)


def test_awkward_rows(documents, awkward, crowded):
    rows = [(r[0], r[1]) for r in awkward]
    compare(rows, crowded(documents(awkward)), 3, 4, 0.5)
    compare([], crowded(documents([])), 3, 4, 0.5)
    # Nothing to learn from: ids 2 and 3 would be; null ids are not.
    unlearned = [(None, "some words"), (None, None)]
    got = M.scored(documents(unlearned), F.expr(LEARN)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(r.score == r.base_score == 0 and r.train_tokens == 0 for r in got)


def test_held_out_texts_are_told_better_than_by_single_words(spark):
    got = QUERIES["op11_suffix_tree"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in got) > 0.97 * sum(r.base_score for r in got) and len(got) > 50
    assert sum(r.score > r.base_score for r in got) > 0.7 * len(got)

