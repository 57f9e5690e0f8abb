"""The divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cofreq.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        group = {s: Counter({t: n for t, n in c.items() if t in kept}) for (g, s), c in counts.items() if g == lang}
        whole = sum(group.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in group.items():
            pairs = [(-sum(f(p(c, t), p(o, t)) for t in kept), other) for other, o in group.items() if other != s]
            terms = [(-f(p(c, t), p(whole, t)), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda e: (e[0], e[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(ranked)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n int, term string")
    out = divergence.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank")
    return sorted(map(tuple, out.collect()))


def texts(seed, n, langs=("en", "de"), sources=9):
    rng = random.Random(seed)
    pool = [f"W{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["été", "ß"]
    rows = []
    for _ in range(n):
        s = rng.choice([0, 0, 0] + list(range(sources)))
        rows.append((rng.choice(langs), f"s{s}", " ".join(pool[min(int(rng.paretovariate(0.6 + s / 10)), 62) - 1] for _ in range(rng.randint(0, 30)))))
    return rows


@pytest.mark.parametrize("size", [dict(), dict(tile=2, part=7, memory=50, shard=40)])
def test_against_plain_counts(spark, size):
    rows = texts(len(size), 150)
    assert run(spark, rows, min_docs=4, top=5, **size) == brute(rows, 4, 5)


def test_awkward_rows(spark):
    rows = [(None, None, None), (None, "a", "x y"), ("", "a", "X"), ("", None, "12 34"), ("en", "a", None), ("en", "b", ""),
            ("en", "a", "x " * 50000)] + [("fr", "one", "le la")] * 40 + [("fr", "two", "la")] * 2 + [("fr", "idle", "7")]
    for n in (1, 2, 50):
        assert run(spark, rows, min_docs=n, top=3) == brute(rows, n, 3)
    assert run(spark, []) == []


def test_a_hot_source(spark):
    rows = texts(5, 60, langs=("en",)) + [("en", "hot", "wa wb wc wa")] * 300
    assert run(spark, rows, min_docs=2, top=4, tile=3, memory=20, shard=30) == brute(rows, 2, 4)


def test_exact_shares():
    rng = random.Random(3)
    for _ in range(2000):
        total = rng.randint(1, 9 * 10**13)
        count = rng.randint(0, total)
        got = divergence._ratio(np.array([count]), np.array([total]))[0]
        assert got == 1 + 10**9 * count // total
