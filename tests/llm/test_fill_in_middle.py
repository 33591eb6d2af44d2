from __future__ import annotations

import hashlib
import re

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from blockloom.llm import fill_in_middle as M
from blockloom.llm.queries import ORACLES, QUERIES


def expected(doc_id, text):
    """The rule in plain steps, unit after unit."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    low, high = sorted([h[0] % (len(units) + 1), h[1] % (len(units) + 1)])
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    "one\ntwo\nthree\nfour\n", "no line feed", "\n", "\n\n\n", "tail\nwithout end", "a <M> inside\nit", "half <S or P>\n<\n>\n", "S>\n<P\nM>\n<",
    "é日本\n𝄞\n" * 5, "carriage\r\nreturn\r\n", "x" * 300_000 + "\n" + "y" * 300_000, "\n" * 50_000,
]


def test_every_text_is_cut_by_the_rule_and_comes_back(spark, documents, awkward):
    rows = awkward + [(100 * i + k, t) for i, t in enumerate(ODD, 1) for k in range(12)]
    docs = documents(rows)
    made = M.transformed(docs)
    got = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_share_and_order_are_parameters(documents):
    docs = documents([(i, "a\nb\nc\n") for i in range(200)])
    forms = lambda **k: {r.form for r in M.transformed(docs, **k).select("form").collect()}
    assert forms(share=0) == {"plain"} and forms(suffix_first=0) == {"psm"} and forms(suffix_first=100) == {"spm"}
    assert M.transformed(docs).exceptAll(M.transformed(docs)).isEmpty() and not M.transformed(docs).exceptAll(M.transformed(docs, seed=8)).isEmpty()


@pytest.mark.parametrize("some", [True, False])
def test_other_columns_pass_through(documents, awkward, crowded, some):
    docs = crowded(documents(awkward if some else []))
    made = M.transformed(docs.withColumn("form", F.lit(1)).withColumn("output", F.lit(2)))
    assert made.columns == [c for c in docs.columns if c not in M.ADDED.fieldNames()] + M.ADDED.fieldNames()
    assert made.count() == (len(awkward) if some else 0)


def test_the_query_equals_its_sql(spark, sf_dir):
    assert difference(spark, duck(sf_dir), QUERIES["op13_fill_in_middle"], ORACLES["op13_fill_in_middle"], sf_dir) is None
