"""Known results on the small sample inputs (FIXTURES.md goldens)."""

import pytest

from cofreq.operators.apriori import apriori
from cofreq.sources import customer_transactions, default_baskets, read_rows
from cofreq.sources.text import baskets_to_rows

from conftest import as_dict, fixture_path, level_sizes


def rows_of(spark, name, item_type="int"):
    return read_rows(spark, fixture_path(name), item_type)


def test_simple_content(spark):
    got = as_dict(apriori(rows_of(spark, "simple.txt"), 2))
    assert got == {(1,): 6, (2,): 7, (3,): 6, (4,): 2, (5,): 2,
                   (1, 2): 4, (1, 3): 4, (1, 5): 2, (2, 3): 4, (2, 4): 2, (2, 5): 2,
                   (1, 2, 3): 2, (1, 2, 5): 2}


def test_simple_last_level_is_the_tutorial_answer(spark):
    got = as_dict(apriori(rows_of(spark, "simple.txt"), 2, report="last_level"))
    assert got == {(1, 2, 3): 2, (1, 2, 5): 2}


def test_default_baskets(spark):
    got = as_dict(apriori(baskets_to_rows(default_baskets(spark)), 2))
    assert got == {(1,): 3, (2,): 3, (3,): 4, (5,): 4,
                   (1, 3): 3, (1, 5): 2, (2, 3): 2, (2, 5): 3, (3, 5): 3,
                   (1, 3, 5): 2, (2, 3, 5): 2}


def test_customer_transactions(spark):
    df = customer_transactions(spark)
    assert df.count() == 8 and df.select("cid").distinct().count() == 2
    got = as_dict(apriori(baskets_to_rows(df), 3))
    assert got == {(1,): 5, (2,): 3, (3,): 6, (4,): 3, (5,): 7,
                   (1, 3): 4, (1, 4): 3, (1, 5): 4, (2, 5): 3, (3, 5): 5, (1, 3, 5): 3}


def test_letters6(spark):
    res = apriori(rows_of(spark, "letters6.txt", "string"), 3)
    assert level_sizes(res) == [6, 7, 4, 1]
    assert as_dict(res.where("k = 4")) == {("t", "x", "y", "z"): 3}


def test_letters5(spark):
    got = as_dict(apriori(rows_of(spark, "letters5.txt", "string"), 3))
    assert got == {("E",): 4, ("K",): 5, ("M",): 3, ("O",): 3, ("Y",): 3,
                   ("E", "K"): 4, ("E", "O"): 3, ("K", "M"): 3, ("K", "O"): 3, ("K", "Y"): 3,
                   ("E", "K", "O"): 3}


def test_synthetic50(spark):
    res = apriori(rows_of(spark, "synthetic50.txt"), 5)
    assert level_sizes(res) == [8, 28, 31, 1]
    assert as_dict(res.where("k = 4")) == {(1, 4, 7, 8): 5}


def test_tau20(spark):
    res = apriori(rows_of(spark, "tau20.txt"), 3)
    assert level_sizes(res) == [8, 3]
    assert as_dict(res.where("k = 2")) == {(2, 5): 6, (5, 9): 3, (6, 8): 3}


@pytest.mark.parametrize("ms, sizes, deepest", [
    (100, [6, 15, 20, 15, 6, 1], ((34, 67, 76, 85, 86, 90), 100)),
    (95, [7, 21, 35, 35, 21, 7, 1], ((34, 59, 67, 76, 85, 86, 90), 99)),
    (90, [8, 28, 56, 70, 56, 28, 8, 1], ((34, 59, 67, 76, 85, 86, 90, 93), 91)),
    (80, [13, 67, 190, 336, 392, 308, 162, 55, 11, 1],
     ((34, 36, 52, 59, 67, 76, 85, 86, 90, 93), 84)),
])
def test_mushroom(spark, ms, sizes, deepest):
    res = apriori(rows_of(spark, "mushroom100.txt"), ms)
    assert level_sizes(res) == sizes
    assert as_dict(res.where(f"k = {len(sizes)}")) == {deepest[0]: deepest[1]}


def test_occurrence_counts_duplicates_for_single_items(spark):
    rows = rows_of(spark, "tau20.txt")
    occ = as_dict(apriori(rows, 1, max_len=1, count_mode="occurrence"))
    pres = as_dict(apriori(rows, 1, max_len=1))
    for item, o, p in [(7, 4, 3), (2, 11, 10), (9, 6, 5), (4, 5, 4), (5, 12, 8)]:
        assert occ[(item,)] == o and pres[(item,)] == p
    syn = as_dict(apriori(rows_of(spark, "synthetic50.txt"), 1, max_len=1,
                          count_mode="occurrence"))
    assert {i: syn[(i,)] for i in (1, 2, 4, 5, 6, 7, 8, 9)} == \
        {1: 18, 2: 32, 4: 61, 5: 25, 6: 31, 7: 38, 8: 30, 9: 27}
