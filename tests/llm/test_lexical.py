"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import pytest

from cofreq.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(words(text)) if c[t])
            if s > 0:
                found.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, k):
    d = spark.createDataFrame([(*r, 7, True) for r in docs], "doc_id bigint, text string, score int, seed boolean")
    q = spark.createDataFrame([(*r, 7) for r in items], "item_id bigint, text string, query int")
    return sorted(map(tuple, lexical.ranked_search(d, q, k).collect()), key=repr)


@pytest.mark.parametrize("k", [3, 40])
def test_against_all_scores(spark, k, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 8192)
    monkeypatch.setattr(lexical, "SEED", 2)
    rng = random.Random(k)
    pool = [f"w{i}" for i in range(300)] + ["Ñu", "ÉCOLE", "x_y-z"]
    text = lambda n: " ".join(pool[min(int(rng.paretovariate(0.7)), len(pool)) - 1] for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(200)] + [(900, " ".join(f"u{i} w{i}" for i in range(3000)))]
    items = [(i, text(8)) for i in range(30)]
    assert run(spark, docs, items, k) == brute(docs, items, k)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (4, "Aa aa AA"), (4, "aa"), (4, "aa"), (None, "aa bb"), (5, "bb " * 70000), (6, "ÀÀ àà")]
    docs += [(i, "aa cc") for i in range(100, 130)]
    items = [(1, "aa bb"), (1, "aa"), (None, "bb"), (2, None), (3, "zz"), (4, "àà"), (5, "")]
    assert run(spark, docs, items, 10) == brute(docs, items, 10)
    assert run(spark, [], items, 3) == [] and run(spark, docs, [], 3) == [] and run(spark, [(1, None)], items, 3) == []


def test_several_passes(spark):
    docs = [(i, f"common t{i % 7} t{i % 11}") for i in range(80)]
    items = [(i, f"t{i} common") for i in range(12)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    out = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"), 5, batch_bytes=200)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(docs, items, 5)


def test_sketch_is_an_upper_bound():
    rng = random.Random(1)
    docs = [(i, 1, Counter(f"w{min(int(rng.paretovariate(0.5)), 500)}".encode() for _ in range(60))) for i in range(50)]
    row = dict(zip([c.split()[0] for c in lexical._BLOCK.split(", ")], lexical._block(docs, 64)))
    sketch = lexical.np.frombuffer(lexical.zstandard.ZstdDecompressor().decompress(row["sketch"]), lexical.np.uint16).reshape(2, 64, 50)
    a, b = lexical._cells(lexical._hashes(row["vocab"]), 64)
    for t, w in enumerate(row["vocab"]):
        for d, (_, _, c) in enumerate(docs):
            assert min(sketch[0][a[t], d], sketch[1][b[t], d]) >= c[w]
