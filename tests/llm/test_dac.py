"""Directly addressable codes: exact round trips and random access."""

from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cofreq.llm import dac
from cofreq.llm.tokens import tokenizer_path


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40), max_size=8),
       st.data())
def test_block_round_trip(ids, data):
    doc_ids = [None if i % 4 == 3 else i - 2 for i in range(len(ids))]
    b = dac.Block(dac.write_block(doc_ids, [np.array(x, np.uint32) for x in ids]))
    flat = [x for row in ids for x in row]
    assert b.doc_ids == doc_ids and b.n_tokens == len(flat)
    assert b.ends.tolist() == np.cumsum([len(x) for x in ids]).astype(int).tolist()
    assert b.tokens(0, len(flat)).tolist() == flat
    assert [b.token(i) for i in range(len(flat))] == flat
    if flat:
        a = data.draw(st.integers(0, len(flat)))
        z = data.draw(st.integers(a, len(flat)))
        assert b.tokens(a, z).tolist() == flat[a:z]


def test_rank_over_many_directory_entries():
    flat = np.random.default_rng(0).integers(0, 70_000, 5000).astype(np.uint32)
    b = dac.Block(dac.write_block([1], [flat]))
    for i in (0, 1, 511, 512, 513, 1024, 4095, 4999):
        assert b.token(i) == flat[i]
    assert (b.tokens(700, 4321) == flat[700:4321]).all()
    with pytest.raises(ValueError):
        dac.Block(b"none" + bytes(20))


def want(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(dac.TOKENIZER))
    out, at = [], 0
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_whole_table_round_trip_and_random_access(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    expected = want(rows)
    path = str(tmp_path / "dac")
    dac.write_tokens(docs.repartition(5), path, block=5000)
    got = sorted(map(tuple, dac.read_documents(spark, path).collect()))
    assert got == [x[:4] for x in expected]
    flat = [t for x in expected for t in x[4]]
    places = [0, 1, 4999, 5000, 77_777, len(flat) - 1, len(flat), 5000]
    tokens = dac.read_tokens(spark, path, spark.createDataFrame([(p,) for p in places], "position bigint"))
    assert {r.position: r.token for r in tokens.collect()} == {p: flat[p] for p in places if p < len(flat)}


def test_awkward_rows(spark):
    rows = [(None, "null id"), (-3, "x" * 3000), (1, "same"), (1, "same"), (2, None), (4, ""), (9, "é \n 𝄞")]
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id bigint, text string, part int, block binary")
    got = sorted(map(tuple, dac.encode_documents(docs).collect()), key=lambda r: r[1])
    assert got == [x[:4] for x in want(rows)]
    assert dac.encode_documents(docs.where("false")).count() == 0
