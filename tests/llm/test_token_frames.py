from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from blockloom.llm import token_frames as F


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(F.model_path())


def expected(rows, library):
    """(doc_id, start, n, crc) in ascending order of distinct ids, null last."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, F.END_ID], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def found(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_whole_table(spark, sf_dir, library):
    from blockloom.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(QUERIES["op2_token_frames"](spark, sf_dir)) == expected(rows, library)


def test_awkward_rows(documents, awkward, crowded, library, tmp_path):
    rows = [r for r in awkward if r[0] != 7 and (r[0] is not None or r[1])]
    rows += [(20, "a<|endoftext|>b 's it's\x1ca b c é ΣΑΣ")]
    files = F.write(crowded(documents(rows)), str(tmp_path), files=3)
    assert found(F.read(files, str(tmp_path))) == expected([r[:2] for r in rows], library)
    again = F.write(documents(awkward), str(tmp_path / "again"), files=3)
    assert F.read(again, str(tmp_path / "again")).count() == len(awkward)


def test_empty_table(documents, tmp_path):
    files = F.write(documents([]), str(tmp_path))
    assert files.count() == 0 and F.read(files, str(tmp_path)).count() == 0


def test_one_document_is_read_on_its_own_and_checked(documents, tmp_path, library):
    rows = [(i, f"text number {i} " * 30) for i in range(50)]
    path = F.write(documents(rows), str(tmp_path), files=1).first().path
    fs, _ = F.open_folder(str(tmp_path))
    with fs.open_input_file(path) as source:
        reader = F.Reader(source)
        assert reader.docs == list(range(50))
        assert reader.ids(33).tolist() == [*library.encode(rows[33][1], add_special_tokens=False).ids, F.END_ID]
        start, length = int(reader.start[33]), int(reader.packed[33])
    data = bytearray(open(path, "rb").read())
    whole = zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    assert len(whole) == int(reader.plain.sum())
    data[start + length // 2] ^= 0xFF
    open(path, "wb").write(data)
    with fs.open_input_file(path) as source:
        reader = F.Reader(source)
        assert len(reader.ids(32)) and len(reader.ids(34))
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.ids(33)
