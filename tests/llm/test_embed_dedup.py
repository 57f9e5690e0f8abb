"""Subspace pigeonhole join against all pairs."""

import numpy as np
import pytest

from cofreq.llm import embed_dedup as E


def brute(rows, cosine=E.COSINE):
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v and None not in v
          and np.isfinite(v).all() and any(v)]
    low = {i: i for i in range(len(rows))}
    links = dict.fromkeys(range(len(rows)), 0)
    comp = {i: {i} for i in ok}
    for x, i in enumerate(ok):
        for j in ok[:x]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                if comp[i] is not comp[j]:
                    both = comp[i] | comp[j]
                    for k in both:
                        comp[k] = both
    out = []
    for i, (k, _) in enumerate(rows):
        c = min(rows[j][0] for j in comp[i]) if i in comp else k
        out.append((k, links[i], c, k is not None and k == c))
    del low
    return sorted(out, key=str)


def got(spark, rows, kind="float"):
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], f"vec_id bigint, embedding array<{kind}>, cid int, label string")
    return sorted(map(tuple, E.near_duplicates(df).collect()), key=str)


def planted(n, dim, seed):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dim) for _ in range(n)]
    for i in range(n // 2):
        c = rng.uniform(0.86, 0.94)
        a = out[i] / np.linalg.norm(out[i])
        b = rng.standard_normal(dim)
        b -= (b @ a) * a
        out.append((c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)) * rng.uniform(0.1, 9))
    return [(int(k), [float(np.float32(x)) for x in v]) for k, v in zip(rng.permutation(len(out)), out)]


@pytest.mark.parametrize("dim", [3, 16, 40])
def test_against_all_pairs(spark, dim):
    rows = planted(120, dim, dim)
    assert got(spark, rows) == brute(rows)


def test_tiles_do_not_change_results(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(20)
    rows = planted(60, 20, 5) + [(1000 + i, (base + 0.05 * rng.standard_normal(20)).tolist()) for i in range(80)]
    monkeypatch.setattr(E, "HOME", 16)
    monkeypatch.setattr(E, "VISITORS", 30)
    assert got(spark, rows, "double") == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]),
            (11, [1e-30, 0.0]), (0, [0.0, 1.0]), (5, [0.0, 3.0]), (12, [3.0]), (13, [0.5])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert sorted(map(tuple, E.near_duplicates(df).collect()), key=str) == brute(rows)
