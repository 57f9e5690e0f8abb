"""Repeated passages against brute force over all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cofreq.llm import substring

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=substring.WINDOW):
    split = [W.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r)[:4] for r in substring.remove_repeats(docs, False).collect()), key=str)


@pytest.mark.parametrize("period", [1, 2, 7, 13, 21])
def test_cover_has_every_difference(period):
    c = substring.difference_cover(period)
    assert {(a - b) % period for a in c for b in c} == set(range(period))


def test_any_two_matching_windows_share_an_anchor():
    for i in range(60):
        for j in range(60):
            assert any(substring.COVER[(i + d) % substring.PERIOD] and substring.COVER[(j + d) % substring.PERIOD]
                       for d in range(substring.PERIOD))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_planted_passages(spark):
    rng = random.Random(7)
    fresh = iter(range(10**9))
    new = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    rows = []
    for i, length in enumerate([34, 35, 36, 50, 90] * 3):
        p = new(length)
        for k in range(3):
            rows.append((10 * i + k, " ".join(new(rng.randint(0, 60)) + p + new(rng.randint(0, 60)))))
    a, b = new(40), new(40)
    rows += [(900, " ".join(a + b)), (901, " ".join(a + new(3))), (902, " ".join(new(2) + b)),
             (903, "For " * 500), (904, " ".join(new(20) * 5)), (905, None), (906, ""), (906, ""),
             (907, " ".join(a[:30] + new(10))), (None, " ".join(new(45))), (908, " ".join(new(80))),
             (909, "tab\tsep\x0bé " * 30), (910, " ".join(f"é{x}" for x in new(40)))]
    rows += [rows[-3]]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, k1 int, runs int")
    assert got(docs.repartition(3)) == brute(rows)
    out = {r.doc_id: r for r in substring.remove_repeats(docs).collect()}
    assert out[900].kept == "" and out[905].kept is None and out[907].n_removed == 0


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert got(spark.createDataFrame([(1, None)], "doc_id bigint, text string")) == brute([(1, None)])
