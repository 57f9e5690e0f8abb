"""MaxScore against all scores."""

import random

import numpy as np
import pytest

from cofreq.llm import topk


def brute(docs, queries, k):
    """Every row but the query's own; a query that is a row of docs is that very tuple."""
    ok = lambda rows: [r for r in rows if r[0] is not None and r[1] is not None and None not in r[1]]
    out = []
    for q in ok(queries):
        cut = lambda n: max(-2**63, min(2**63 - 1, n))
        s = sorted((-cut(sum(a * b for a, b in zip(q[1], d[1]))), d[0]) for d in ok(docs) if d is not q and len(d[1]) == len(q[1]))[:k]
        out += [(q[0], r + 1, j, -y) for r, (y, j) in enumerate(s)]
    return sorted(out)


def run(spark, docs, queries, k, **kw):
    number = {id(d): i for i, d in enumerate(docs)}
    make = lambda rows: spark.createDataFrame([(*r, number.get(id(r), -1 - i), 1, 0) for i, r in enumerate(rows)],
                                              "vec_id bigint, vector array<bigint>, row bigint, shard int, rank int")
    return sorted(map(tuple, topk.top_k(make(docs), make(queries), k, **kw).collect()))


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_shards_and_blocks(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "SEED", 8)
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = random.Random(spread)
    docs = [(i, [rng.randint(-spread, spread) for _ in range(12)]) for i in range(300)]
    queries = docs[::9] + [(1000, [0] * 12), (1001, [5, -5] * 6)]
    assert run(spark, docs, queries, 7, shard=90, block=10) == brute(docs, queries, 7)


def test_pruning_keeps_every_result():
    rng = np.random.default_rng(1)
    docs = np.floor(rng.standard_normal((5000, 32)) * 8 * np.geomspace(1, 0.05, 32)).astype(np.int64)
    shard = topk.Shard(np.arange(5000)[::-1].copy(), docs)
    ids = np.arange(5000)[::-1]
    for i in range(0, 200, 5):
        got = shard.top(docs[i], int(ids[i]), 20)
        s = docs @ docs[i]
        want = sorted((-int(x), int(j)) for x, j in zip(s, ids) if j != ids[i])[:20]
        assert list(zip(-got[1].astype(int), got[0])) == want


def test_awkward_rows(spark):
    docs = [(1, [1, 2]), (2, [1, 2]), (2, [0, 0]), (3, None), (4, [None, 1]), (None, [9, 9]), (5, [1, 2, 3]), (6, [7]),
            (7, []), (8, []), (9, [2**40, 2**40]), (10, [1, 2]), (10, [1, 2]), (10, [3, 1])]
    docs = [tuple(d) for d in docs]
    queries = [d for d in docs] + [(99, [2**41, -1])]
    assert run(spark, docs, queries, 3) == brute(docs, queries, 3)
    assert run(spark, [], queries, 3) == [] and run(spark, docs, [], 3) == []


def test_a_repeated_id_is_many_rows(spark):
    docs = [(1, [1, 0]), (1, [5, 0]), (2, [3, 3])] + [(7, [i, 1]) for i in range(60)]
    assert run(spark, docs, docs, 5, shard=16, block=8) == brute(docs, docs, 5)


def test_quantized(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([0.1, -0.1, 0.0],), ([nan],), ([inf],), ([None, 1.0],), (None,), ([],)]
    out = spark.createDataFrame(rows, "e array<float>").select(topk.quantized(__import__("pyspark").sql.functions.col("e"))).collect()
    assert [r[0] for r in out] == [[6, -7, 0], None, None, None, None, []]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    docs = [(r.vec_id, [int(np.floor(64 * float(x))) for x in r.embedding]) for r in df.collect()]
    want = brute(docs, [d for d in docs if d[0] % 20 == 0], 20)
    assert sorted(map(tuple, topk.embedding_top_k(df).collect())) == want
