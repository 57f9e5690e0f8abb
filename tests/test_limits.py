"""No hidden caps, silent drops or failures outside the registered inputs."""

import os
import tempfile
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cofreq.operators.apriori import apriori, r_apriori
from cofreq.operators.candidates import candidates, count_containment
from cofreq.operators.eclat import eclat, merge_tidsets, bitset_support, tid_bitsets
from cofreq.operators.encode import decode, encode
from cofreq.operators.fpgrowth import fpgrowth
from cofreq.operators.ordered import ordered_patterns, prefixspan
from cofreq.operators.prepare import clean_rows
from cofreq.operators.rules import association_rules
from cofreq.plans.pipelines import retail_prepare
from cofreq.session import broadcast_if_small, cleanup, materialize, run_folder
from cofreq.sources import count_lines, read_baskets, read_rows

from conftest import as_dict, fixture_path


def rows_of(spark, baskets):
    return spark.createDataFrame([(t, i) for t, b in baskets.items() for i in b], "tid bigint, item int")


def _file(lines):
    p = os.path.join(tempfile.mkdtemp(prefix="cofreq-test-"), "in.txt")
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


def test_prefixspan_has_no_length_cap(spark):
    ev = spark.createDataFrame([(t, i, i) for t in (1, 2) for i in range(12)], "tid int, item int, ts int")
    got = as_dict(prefixspan(ev, 2), "pattern")
    assert got == as_dict(ordered_patterns(ev, 2), "pattern") and max(map(len, got)) == 12


def test_prefixspan_counts_cleaned_rows(spark):
    ev = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 1), (3, None, 1), (4, None, 1), (None, 1, 1)],
                               "tid int, item int, ts int")
    assert as_dict(prefixspan(ev, 2), "pattern") == as_dict(ordered_patterns(ev, 2), "pattern") == {(1,): 2}


@pytest.mark.parametrize("miner", [apriori, eclat, fpgrowth, r_apriori])
def test_support_above_n_and_empty_input(spark, miner):
    rows = rows_of(spark, {1: [1, 2], 2: [1, 3]})
    assert as_dict(miner(rows, 20)) == {}
    assert as_dict(miner(rows.where("false"), 2)) == {}
    assert as_dict(miner(rows.where("false"), 0.5)) == {}


def test_ordered_above_n_and_empty_input(spark):
    ev = spark.createDataFrame([(1, 1, 1)], "tid int, item int, ts int")
    for miner in (ordered_patterns, prefixspan):
        assert as_dict(miner(ev, 2), "pattern") == {}
        assert as_dict(miner(ev.where("false"), 1), "pattern") == {}


def test_r_apriori_refuses_larger_sets(spark):
    rows = rows_of(spark, {1: [1, 2, 3, 4]})
    for kw in ({"max_len": 4}, {"report": "exact_k", "k": 5}):
        with pytest.raises(ValueError):
            r_apriori(rows, 1, **kw)
    from cofreq.__main__ import main
    for extra in (["--k", "5"], ["--go-on", "--k", "2"]):
        with pytest.raises(SystemExit):
            main(["r-apriori", fixture_path("simple.txt"), "2", "--out", "/tmp/none", *extra])


def test_sources_are_strict_and_know_bigint(spark):
    p = _file(["4006381333931 4006381333948", "4006381333931"])
    with pytest.raises(Exception):
        read_baskets(spark, p).collect()
    assert as_dict(apriori(read_rows(spark, p, "bigint"), 2)) == {(4006381333931,): 2}
    assert read_baskets(spark, p, lenient=True).count() == 0


def test_share_of_all_lines(spark):
    p = _file(["1 2", "", "1", "", "", "2", "1 2", ""])
    rows, n = read_rows(spark, p), count_lines(spark, p)
    assert n == 8
    for miner in (apriori, eclat, fpgrowth, r_apriori):
        assert as_dict(miner(rows, Fraction(3, 8), n_baskets=n)) == {(1,): 3, (2,): 3}
        assert (1, 2) in as_dict(miner(rows, Fraction(3, 8)))


def test_candidates_of_several_sizes(spark):
    rows = read_rows(spark, fixture_path("simple.txt"))
    mixed = spark.createDataFrame([([1, 2],), ([1, 2, 3],), ([9],)], "itemset array<int>")
    truth = as_dict(apriori(rows, 1))
    got = as_dict(count_containment(rows, mixed))
    assert got == {(1, 2): truth[1, 2], (1, 2, 3): truth[1, 2, 3], (9,): 0}
    for bad in (mixed, spark.createDataFrame([([1],), ([2],)], "itemset array<int>")):
        with pytest.raises(ValueError):
            candidates(bad)
    assert candidates(mixed.where("false")).count() == 0


def test_unknown_items_and_ids_stop_the_job(spark):
    d = spark.createDataFrame([("a", 1), ("b", 2)], "item string, item_id int")
    with pytest.raises(Exception, match="not in the dictionary"):
        encode(spark.createDataFrame([(1, "z")], "tid int, item string"), d).collect()
    with pytest.raises(Exception, match="not in the dictionary"):
        decode(spark.createDataFrame([([1, 9], 2)], "itemset array<int>, support int"), d).collect()
    assert as_dict(decode(spark.createDataFrame([([2, 1], 2)], "itemset array<int>, support int"), d)) == {("a", "b"): 2}


def test_rules_need_every_level_and_do_not_overflow(spark):
    rows = rows_of(spark, {1: [1, 2, 3], 2: [1, 2, 3], 3: [1]})
    with pytest.raises(Exception, match="all levels"):
        association_rules(apriori(rows, 2, report="exact_k", k=3)).collect()
    assert association_rules(apriori(rows, 2), 0.1).count() == 9
    big = 9 * 10 ** 18
    sets = spark.createDataFrame([([1], big), ([2], big), ([1, 2], big // 3)], "itemset array<int>, support bigint")
    assert association_rules(sets, 1 / 3).count() == 2
    assert association_rules(sets, 0.3333333333333334).count() == 0


def test_occurrence_count_with_minimum_basket(spark):
    rows = rows_of(spark, {1: [7, 7, 7], 2: [1, 2, 3, 3], 3: [1, 2, 3]})
    got = as_dict(apriori(rows, 2, count_mode="occurrence", min_basket_size=3))
    assert (7,) not in got and got[(3,)] == 3 and got[(1,)] == 2


def test_null_transaction_ids_belong_to_no_basket(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 2), (2, None)], "tid int, item int")
    for miner in (apriori, eclat, fpgrowth, r_apriori):
        assert as_dict(miner(rows, 1.0)) == {(1,): 1, (2,): 1, (1, 2): 1}


def test_cleaning_keeps_values(spark):
    df = spark.createDataFrame([("1", " 22"), ("1", "22"), (" ", "3"), ("2", "  ")], "tid string, item string")
    assert sorted(map(tuple, clean_rows(df, "tid", "item").collect())) == [("1", " 22"), ("1", "22")]


def test_first_time_of_a_repeated_item_counts(spark):
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    line = "{},{},x,1,01/02/2020 {}:00:00,1.0,c,UK".format
    a, b, c = line(1, "A", "08"), line(1, "B", "09"), line(1, "A", "10")
    for order in ([a, b, c], [c, b, a], [b, c, a]):
        out = retail_prepare(spark, _file([head, *order]), time_ordered=True).collect()
        assert [list(r["items"]) for r in out] == [["A", "B"]]


@pytest.mark.parametrize("strategy", ["pairs", "extend"])
def test_wide_basket_is_split_at_every_level(spark, strategy):
    """Occurrences of a level can outnumber a basket's rows."""
    baskets = {t: list(range(7)) for t in range(2)}
    got = as_dict(apriori(rows_of(spark, baskets), 2, strategy=strategy, max_group=8))
    assert len(got) == 2 ** 7 - 1 and set(got.values()) == {2}


def test_tidset_merge(spark):
    rows = rows_of(spark, {t: [1, 2] for t in range(70)})
    bits = tid_bitsets(rows, dense=False).withColumn("itemset", F.array("item"))
    halves = bits.select("itemset", "word", F.col("bits").bitwiseAND(F.lit(0x5555555555555555)).alias("bits")) \
        .unionAll(bits.select("itemset", "word", "bits"))
    assert {r["itemset"][0]: r["support"] for r in
            bitset_support(merge_tidsets(halves), ["itemset"]).collect()} == {1: 70, 2: 70}


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(wide))
    assert "broadcast" not in plan(broadcast_if_small(wide, limit=40_000))
    assert "broadcast" not in plan(broadcast_if_small(wide.select(F.array("s").alias("a")), limit=40_000))
    assert "broadcast" not in plan(broadcast_if_small(spark.range(10), bound=10 ** 9))


def test_cleanup_removes_the_run_folder(spark):
    materialize(spark.range(3), "some")
    path = run_folder(spark).removeprefix("file:")
    assert os.listdir(path)
    cleanup(spark)
    assert not os.path.exists(path)
