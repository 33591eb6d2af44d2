from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from blockloom.llm import language, quality, toxicity
from blockloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def out_of_training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_on_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, SF).collect()
    assert len(got) == len(truth) and all(r.held_out == out_of_training(r.doc_id) and 0 <= r.score <= 1 for r in got)
    judged = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(judged) / len(judged) > 0.97


def test_quality_and_toxicity_on_held_out_rows(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, label, least in (("op10_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.9)):
        got = QUERIES[name](spark, SF).collect()
        assert all(r.held_out == out_of_training(r.doc_id) and 0 <= r.score <= 1 for r in got)
        judged = [r.predicted == truth[r.doc_id][label] for r in got if r.held_out and r.doc_id in truth]
        assert sum(judged) / len(judged) >= least


def test_labels_of_held_out_rows_are_not_learned_from(spark, documents):
    rows = [(i, "good words here" if i % 2 else "bad words there", "en", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = documents(rows)
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_pairs_of_terms_count_more_than_each_alone():
    import numpy as np

    known = toxicity.Terms()
    both, one, other, none = (known.of(t) for t in ("insult group of", "insult of", "group of", "of"))
    rows = [both, one, other, none] * 60
    y = np.array([1.0, 0, 0, 0] * 60)
    model = toxicity.fit_rows(rows, y, np.ones(len(y)))
    s = model.score([both, one, other, none])
    assert s[0] > 0.5 > max(s[1:])


def test_pair_tables_learn_an_interaction():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.uniform(size=(2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_table(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_awkward_rows(spark, documents, awkward, crowded, rows):
    rows = awkward if rows == "awkward" else []
    docs = crowded(documents(rows))
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, None), (None, 1, 1), (7, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for labelled in (labels, labels.where("false")):
        for operator in (quality, toxicity):
            got = operator.assess(docs, operator.fit(docs, labelled))
            assert got.count() == len(rows) and got.where("score < 0 or score > 1 or score is null").count() == 0
    got = language.identify(docs, *language.fit(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    least = language.CHANCE / language.SIZE**0.5 if language.fit(docs)[0] else 0
    kept = language.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" and r.score >= least for r in got)


def test_a_pair_of_neutral_terms_is_learned():
    import numpy as np

    known = toxicity.Terms()
    both, one, other, none = (known.of(t) for t in ("insult group", "insult", "group", "of"))
    y = np.array([1.0, 0, 0, 1.0] * 60)
    s = toxicity.fit_rows([both, one, other, none] * 60, y, np.ones(len(y))).score([both, one, other, none])
    assert min(s[0], s[3]) > 0.5 > max(s[1:3])


def test_a_rare_term_of_toxic_texts_only_is_learned():
    import numpy as np

    rows = [np.array([k], dtype=np.int32) for k in [1] * 100 + [2] * 5 + [1] * 95]
    y = np.array([0.0] * 100 + [1.0] * 100)
    model = toxicity.fit_rows(rows, y, np.ones(len(y)))
    low, high = model.score([np.array([1], dtype=np.int32), np.array([2], dtype=np.int32)])
    assert high > max(low, 0.5)


def test_texts_stay_if_no_language_was_learned(spark, documents):
    docs = documents([(1, "some words", None), (2, None, None), (3, "12 !", None), (4, "words", None)])
    assert {r.doc_id for r in language.known_language(docs).collect()} == {1, 4}


def plain_vector(text):
    """Letter triples one by one."""
    import numpy as np

    known = language.letters()
    out = np.zeros(language.SIZE)
    text = f"\n{(text or '').lower()}\n"
    letter = lambda c: ord(c) if c.isalpha() else 0
    for a, b, c in zip(text, text[1:], text[2:]):
        if letter(b):
            out += np.roll(known.vector(letter(a)), 2) * np.roll(known.vector(letter(b)), 1) * known.vector(letter(c))
    length = np.linalg.norm(out)
    return out / length if length else out


def test_languages_equal_those_of_plain_loops(spark, sf_dir, documents, awkward):
    import numpy as np

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(80)
    docs = docs.select("doc_id", F.substring("text", 1, 1500).alias("text"), "lang", "source", "n_chars").unionByName(documents([r for r in awkward if r[0] != 8]))
    rows = docs.collect()
    vectors, profiles = [plain_vector(r.text) for r in rows], {}
    for r, v in zip(rows, vectors):
        if r.lang is not None and not out_of_training(r.doc_id):
            profiles[r.lang] = profiles.get(r.lang, 0) + np.rint(v * language.GRAIN)
    profiles = {k: v / np.linalg.norm(v) for k, v in sorted(profiles.items()) if v.any()}
    want = []
    for r, v in zip(rows, vectors):
        best = max(profiles, key=lambda k: round(float(v @ profiles[k]), 6)) if v.any() else "und"
        want.append((str(r.text), best, round(max(float(v @ profiles[best]), 0), 5) if v.any() else 0))
    got = [(str(r.text), r.lang_pred, round(r.score, 5)) for r in language.identify(docs, *language.fit(docs)).collect()]
    assert sorted(got) == sorted(want)


def test_equal_cosines_go_to_the_first_language(documents):
    docs = documents([(1, "same words", "zz"), (2, "same words", "aa"), (3, "same words", "mm")])
    languages, vectors = language.fit(docs)
    assert languages == sorted(languages) and {r.lang_pred for r in language.identify(docs, languages, vectors).collect()} == {languages[0]}


def test_texts_in_no_learned_language_go(spark, sf_dir, documents):
    known = spark.read.parquet(f"{sf_dir}/documents.parquet")
    strange = ["Это русский текст о погоде и жизни в большом городе. " * 5, "日本語のテキストです、これは長い文章ではありません。" * 5, "Ζει στην Αθήνα και δουλεύει κάθε μέρα. " * 3]
    planted = documents([(5 * 10**6 + i, t, None, "planted") for i, t in enumerate(strange)])
    kept = {r.doc_id for r in language.known_language(known.unionByName(planted)).select("doc_id").collect()}
    assert not [i for i in kept if i >= 5 * 10**6]
    assert {r.doc_id for r in known.where("text rlike '[A-Za-z]{4}'").select("doc_id").collect()} <= kept


def test_toxicity_scores_equal_all_pairs_of_terms(spark, sf_dir):
    import numpy as np

    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    some = docs.orderBy("doc_id").limit(60)
    place = {int(p): i for i, p in enumerate(model.places)}
    got = {r.doc_id: r.score for r in toxicity.assess(some, model).select("doc_id", "score").collect()}
    for r in some.collect():
        terms = [place[t] for t in toxicity.Terms().of(r.text).tolist() if t in place]
        raw = model.bias + sum(model.weight[t] for t in terms)
        for i, a in enumerate(terms):
            raw += float((model.factor[terms[i + 1 :]] @ model.factor[a]).sum())
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(raw, -30, 30))), abs=1e-6)


def test_pairs_in_texts_are_all_counted():
    """The signal of block pairs equals a count of every pair of terms in every text."""
    import numpy as np

    rng = np.random.default_rng(2)
    texts, terms = 90, 23
    there = rng.random((texts, terms)) < 0.4
    there[0] = True
    y = np.array([1.0] * 40 + [0.0] * 50)
    row = np.concatenate([np.flatnonzero(there[:, k]) for k in range(terms)])
    high = np.cumsum(there.sum(0))
    odds = rng.normal(size=terms)
    for size, at_once in ((5, 17), (512, 4_000_000)):
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(toxicity, "PAIRS", size)
            patched.setattr(toxicity, "AT_ONCE", at_once)
            pairs = toxicity.Pairs(texts, 40, row, high - there.sum(0), high, odds, 1.5)
            got = toxicity._on_driver(pairs)
        want = np.zeros(terms)
        for a in range(terms):
            for b in range(terms):
                both = int((there[:, a] & there[:, b]).sum())
                if a != b and both >= toxicity.LEAST_TEXTS:
                    bad, q = float(y[there[:, a] & there[:, b]].sum()), 1 / (1 + np.exp(-(odds[a] + odds[b])))
                    part = lambda n, e: n * np.log(max(n, 1e-6) / max(e, 1e-6))
                    told = 2 * (part(bad, both * q) + part(both - bad, both * (1 - q))) - 1.5
                    want[a] = max(want[a], np.sqrt(max(told, 0)))
        assert got == pytest.approx(want)


def test_quality_scores_equal_one_bin_after_another(spark, sf_dir):
    import bisect

    import numpy as np

    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs, labels)
    some = docs.orderBy("doc_id").limit(100)
    got = {r.doc_id: r.score for r in quality.assess(some, model).select("doc_id", "score").collect()}
    for r in some.collect():
        x = quality.features(r.text)
        raw = model.start
        for i, (edges, values) in enumerate(zip(model.edges, model.tables)):
            raw += values[bisect.bisect_left(list(edges), x[i])]
        for i, j, values in model.pairs:
            raw += values[bisect.bisect_left(list(model.pair_edges[i]), x[i])][bisect.bisect_left(list(model.pair_edges[j]), x[j])]
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-6)
