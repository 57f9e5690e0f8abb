"""One basket holding a third of all rows: the blocked joins must give the
exact brute-force answer."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from cofreq.operators import ordered
from cofreq.operators.apriori import apriori
from cofreq.operators.eclat import eclat
from cofreq.operators.groupjoin import group_join
from cofreq.operators.ordered import ordered_patterns

from conftest import as_dict


def _data(seed=7):
    rnd = random.Random(seed)
    baskets = {0: list(range(120))}                       # the hot basket
    for t in range(1, 61):
        baskets[t] = rnd.sample(range(40), rnd.randint(2, 6))
    return baskets


def _brute(baskets, ms, max_len):
    counts = Counter()
    for items in baskets.values():
        s = sorted(set(items))
        for k in range(1, max_len + 1):
            counts.update(combinations(s, k))
    return {c: n for c, n in counts.items() if n >= ms}


def test_hot_basket_is_split_and_exact(spark):
    baskets = _data()
    rows = spark.createDataFrame([(t, i) for t, items in baskets.items() for i in items],
                                 "tid bigint, item int")
    assert len(baskets[0]) * 3 >= sum(len(v) for v in baskets.values())
    want = _brute(baskets, 4, 3)
    assert as_dict(apriori(rows, 4, max_len=3, max_group=16)) == want
    assert as_dict(apriori(rows, 4, max_len=3, max_group=16, strategy="extend")) == want
    assert as_dict(eclat(rows, 4, max_len=3, max_group=16)) == want


def test_hot_sequence_is_split_and_exact(spark):
    rnd = random.Random(3)
    seqs = {0: [rnd.randrange(6) for _ in range(80)]}
    for t in range(1, 40):
        seqs[t] = [rnd.randrange(6) for _ in range(rnd.randint(1, 5))]
    rows = spark.createDataFrame([(t, x, p) for t, s in seqs.items() for p, x in enumerate(s)],
                                 "tid bigint, item int, pos int")

    def contains(seq, pat):
        it = iter(seq)
        return all(any(x == p for x in it) for p in pat)

    want = {}
    for k in (1, 2):
        for pat in {tuple(c) for s in seqs.values() for c in combinations(s, k)}:
            n = sum(contains(s, pat) for s in seqs.values())
            if n >= 5:
                want[pat] = n
    got = {tuple(r["pattern"]): r["support"] for r in
           ordered_patterns(rows, 5, order=("pos",), max_len=2, max_group=8).collect()}
    assert got == want


def test_ordered_steps_are_dealt_by_their_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = spark.createDataFrame([(t, rng.randrange(8), p) for t in range(400) for p in range(6)], "tid int, item int, pos int")
    mine = lambda: {tuple(r["pattern"]): r["support"] for r in ordered_patterns(rows, 5, order=("pos",), max_len=3).collect()}
    want, largest = mine(), []

    def watched(*args, **kw):
        out = group_join(*args, **kw)
        largest.append(max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()))
        return out
    monkeypatch.setattr(ordered, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(ordered, "group_join", watched)
    assert mine() == want
    # 6000 pairs of an event and a later one
    assert len(largest) == 2 and max(largest) < 600
