"""Different miners and strategies give the same itemsets; properties of
results; skew handling gives the same answer as the plain join."""

import pytest
from pyspark.sql import functions as F

from cofreq.operators.apriori import apriori, r_apriori
from cofreq.operators.candidates import candidates, count_containment
from cofreq.operators.eclat import eclat
from cofreq.operators.encode import build_dictionary, dense_ids
from cofreq.operators.fpgrowth import fpgrowth
from cofreq.operators.groupjoin import group_join, pairs_within
from cofreq.operators.ordered import ordered_patterns, prefixspan
from cofreq.operators.rules import association_rules
from cofreq.sources import read_rows

from conftest import as_dict, fixture_path


@pytest.fixture(scope="module")
def synth(spark):
    return read_rows(spark, fixture_path("synthetic50.txt"))


@pytest.fixture(scope="module")
def mush(spark):
    return read_rows(spark, fixture_path("mushroom100.txt"))


def test_miners_agree_on_synthetic(synth):
    ref = as_dict(apriori(synth, 5))
    assert as_dict(apriori(synth, 5, strategy="extend")) == ref
    assert as_dict(eclat(synth, 5)) == ref
    assert as_dict(eclat(synth, 5, dense=False)) == ref
    assert as_dict(fpgrowth(synth, 5)) == ref
    assert as_dict(r_apriori(synth, 5)) == {k: v for k, v in ref.items() if len(k) <= 3}
    assert as_dict(r_apriori(synth, 5, discard=False)) == \
        {k: v for k, v in ref.items() if len(k) <= 3}


def test_miners_agree_on_mushroom(mush):
    ref = as_dict(apriori(mush, 90))
    assert as_dict(eclat(mush, 90)) == ref
    assert as_dict(fpgrowth(mush, 90)) == ref


def test_fractional_support_is_exact(synth):
    # 50 baskets: 7/50 must mean support >= 7, never 8
    assert as_dict(apriori(synth, (7, 50))) == as_dict(apriori(synth, 7))
    assert as_dict(fpgrowth(synth, (7, 50))) == as_dict(apriori(synth, 7))
    assert as_dict(apriori(synth, 0.14)) == as_dict(apriori(synth, 7))


def test_downward_closure_and_monotone_support(mush):
    res = as_dict(apriori(mush, 95))
    for items, sup in res.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert sub in res and res[sub] >= sup


def test_report_modes(synth):
    assert set(as_dict(apriori(synth, 5, report="exact_k", k=3))) == \
        {k for k in as_dict(apriori(synth, 5)) if len(k) == 3}
    assert as_dict(apriori(synth, 5, report="exact_k", k=9)) == {}
    assert {len(k) for k in as_dict(apriori(synth, 5, report="from_k", k=3))} == {3, 4}
    assert {len(k) for k in as_dict(apriori(synth, 5, report="last_level"))} == {4}
    assert {len(k) for k in as_dict(apriori(synth, 5, max_len=2))} == {1, 2}


def test_hot_groups_are_split_exactly(spark, synth):
    # max_group=2 forces every basket through the blocked join
    ref = as_dict(apriori(synth, 5))
    assert as_dict(apriori(synth, 5, max_group=2)) == ref
    assert as_dict(apriori(synth, 5, max_group=2, strategy="extend")) == ref
    assert as_dict(eclat(synth, 5, max_group=2)) == ref
    assert as_dict(r_apriori(synth, 5, max_group=2)) == \
        {k: v for k, v in ref.items() if len(k) <= 3}


def test_group_join_blocks_match_plain_join(spark):
    left = spark.range(0, 300).select((F.col("id") % 3).alias("g"), F.col("id").alias("a"))
    right = spark.range(0, 40).select((F.col("id") % 4).alias("g"), F.col("id").alias("b"))
    plain = sorted(map(tuple, left.join(right, "g").collect()))
    blocked = sorted(map(tuple, group_join(left, right, ["g"], left_spread=["a"],
                                           right_spread=["b"], max_group=7).collect()))
    assert blocked == plain
    pairs = pairs_within(left, ["g"], "a", max_group=5)
    assert pairs.count() == 3 * (100 * 99 // 2)
    assert pairs.where("a_a >= a_b").count() == 0


def test_candidates_and_containment(synth):
    l2 = apriori(synth, 5, report="exact_k", k=2)
    cand = candidates(l2)
    counted = as_dict(count_containment(synth, cand))
    freq3 = as_dict(apriori(synth, 5, report="exact_k", k=3))
    assert {k: v for k, v in counted.items() if v >= 5} == freq3
    unpruned = {tuple(r["itemset"]) for r in candidates(l2, prune=False).collect()}
    assert set(counted) <= unpruned
    # every candidate's 2-subsets are frequent pairs
    pairs = set(as_dict(l2))
    for c in counted:
        assert all(p in pairs for p in [(c[0], c[1]), (c[0], c[2]), (c[1], c[2])])


def test_rules_on_simple(spark):
    rows = read_rows(spark, fixture_path("simple.txt"))
    rules = association_rules(apriori(rows, 2), 0.0, n_baskets=9)
    assert rules.count() == 18
    r = {(tuple(x["antecedent"]), x["consequent"]): x for x in rules.collect()}
    assert r[((1, 2), 3)]["confidence"] == pytest.approx(0.5)
    assert r[((5,), 1)]["confidence"] == pytest.approx(1.0)
    assert r[((5,), 1)]["lift"] == pytest.approx(1.0 / (6 / 9))
    strict = association_rules(apriori(rows, 2), (1, 1), n_baskets=9)
    assert {(tuple(x["antecedent"]), x["consequent"]) for x in strict.collect()} == \
        {((5,), 1), ((5,), 2), ((4,), 2), ((1, 5), 2), ((2, 5), 1)}


def test_ordered_patterns_match_prefixspan(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, "c", 3), (1, "a", 4),
         (2, "b", 1), (2, "a", 2), (2, "c", 3),
         (3, "a", 1), (3, "c", 2), (3, "b", 3), (3, "c", 4),
         (4, "a", 1), (4, "b", 2)], "tid bigint, item string, ts int")
    ours = {tuple(r["pattern"]): r["support"]
            for r in ordered_patterns(rows, 2, order=("ts",)).collect()}
    theirs = {tuple(r["pattern"]): r["support"]
              for r in prefixspan(rows, 2, order=("ts",)).collect()}
    assert ours == theirs
    assert ours[("a", "b")] == 3 and ours[("b", "a")] == 2 and ours[("a", "c")] == 3


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(13)
    ids = dense_ids(df, [F.col("v")], "rid", start=1).collect()
    assert sorted(r["rid"] for r in ids) == list(range(1, 1001))
    assert all(r["rid"] == r["v"] + 1 for r in ids)


def test_dictionary_orders(spark, synth):
    d = {r["item"]: (r["item_id"], r["support"]) for r in build_dictionary(synth).collect()}
    by_id = sorted(d.items(), key=lambda kv: kv[1][0])
    sups = [v[1] for _, v in by_id]
    assert sups == sorted(sups, reverse=True)
    assert [v[0] for _, v in by_id] == list(range(1, len(d) + 1))
