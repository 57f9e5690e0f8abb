"""Ids of the remembering encoder against the tokenizer itself."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cofreq.llm import tokens

FILES = [("word_bpe_49k.json", 2), ("byte_bpe_50k.json", 0)]
_made = {}


def pair(name, end):
    if name not in _made:
        from tokenizers import Tokenizer
        path = tokens.tokenizer_path(name)
        _made[name] = tokens.Encoder(path, end), Tokenizer.from_file(path)
    return _made[name]


def same(name, end, texts):
    own, plain = pair(name, end)
    for t, got in zip(texts, own.encode_many(texts)):
        want = plain.encode(t or "", add_special_tokens=False).ids + [end]
        assert np.frombuffer(got, own.dtype).tolist() == want, repr(t)


ODD = ["a", "B", "é", "ñ", "é", "́", " ", " ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0",
       "　", "'s", "'", "'LL", "12", "Ⅷ", "½", ".", "!!", "<|endoftext|>", "<|startoftext|>", "<", "|", "𝄞",
       "你", "ſ", "İ", "Σ", "ς", "‍", "﻿", "\x00", "_", "-", "~", " ~", "on", "the"]


@pytest.mark.parametrize("name,end", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(ODD), max_size=14).map("".join), max_size=4))
def test_odd_texts(name, end, texts):
    same(name, end, texts)


@pytest.mark.parametrize("name,end", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=30), max_size=3))
def test_any_texts(name, end, texts):
    same(name, end, texts)


LATIN = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x180), 0x2013, 0x2019, 0x2026, 0x20AC]]


@pytest.mark.parametrize("name,end", FILES)
@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(st.one_of(st.sampled_from(LATIN), st.sampled_from(
    [" the", "ing", " ", ".", "ß", "Ä", "ció", "1", "''", "<|endoftext|>", "'s", "'RE", "!!", "\n\n", "  "])),
    max_size=25).map("".join), max_size=4))
def test_latin_texts(name, end, texts):
    same(name, end, texts)


@pytest.mark.parametrize("name,end", FILES)
def test_both_files_are_merged_directly(name, end):
    assert pair(name, end)[0].merger is not None


@pytest.mark.parametrize("name,end", FILES)
def test_without_the_merger(name, end):
    import pyarrow.parquet as pq
    own, plain = pair(name, end)
    slow = tokens.Encoder(tokens.tokenizer_path(name), end)
    slow.merger = None
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    assert slow.encode_many(texts) == own.encode_many(texts)


@pytest.mark.parametrize("name,end", FILES)
def test_nulls_and_forgetting(name, end, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    rng = random.Random(4)
    texts = [None, ""] + [" ".join(rng.choice(["on", "the", "x" * 60, "tion,", "él.\nLa"]) + str(rng.randint(0, 30))
                                   for _ in range(40)) for _ in range(12)]
    same(name, end, texts)


@pytest.mark.parametrize("name,end", FILES)
def test_corpus(name, end):
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    same(name, end, texts)
