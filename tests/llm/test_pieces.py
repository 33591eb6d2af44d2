from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece

from blockloom.llm import pieces as P


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.model_path())


def test_random_texts(library):
    model, rng = P.Pieces(P.model_path()), random.Random(3)
    letters = "abcdetheing \n\t\r▁  é日本́\xa0\x00①ñß😀.,!0123<>ABC"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    texts += [" " * n + "x" + " " * n for n in range(40)] + ["", " ", "▁", "a▁▁b", "<s>", "\n\n"]
    for text in texts:
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids
        assert model.decode(ids) == library.decode(ids)


def test_every_document(spark, sf_dir, library):
    from blockloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op8_sentencepiece"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_awkward_rows(documents, awkward, crowded, library):
    df = crowded(documents(awkward))
    out = P.decode(P.encode(df)).collect()
    assert len(out) == len(awkward)
    for r in out:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    assert P.encode(documents([])).count() == 0
