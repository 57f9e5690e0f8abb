"""Column functions, small operators and miner options."""

from pyspark.sql import functions as F

from cofreq import functions as CF
from cofreq.operators.apriori import apriori
from cofreq.operators.eclat import eclat, merge_tidsets, tid_bitsets
from cofreq.operators.encode import decode
from cofreq.operators.prepare import ordered_baskets, profile, to_baskets
from cofreq.operators.support import keep_baskets

from conftest import as_dict


def test_set_and_parse_functions(spark):
    df = spark.createDataFrame([("1 2  3 ", "1,x,3", [1, 2, 3], [1, 3], [4])],
                               "line string, csv string, b array<int>, s array<int>, t array<int>")
    r = df.select(CF.tokens("line").alias("tok"),
                  CF.cast_items(CF.tokens("line")).alias("ints"),
                  CF.comma_items("csv").alias("csv_ints"),
                  CF.contains_all("b", "s").alias("c1"),
                  CF.contains_all("b", "t").alias("c2"),
                  CF.intersect("b", "s").alias("i"),
                  CF.add_item("s", F.lit(2)).alias("u"),
                  CF.itemset_text("s").alias("txt")).first()
    assert r["tok"] == ["1", "2", "3"] and r["ints"] == [1, 2, 3]
    assert r["csv_ints"] == [1, 3]
    assert r["c1"] is True and r["c2"] is False
    assert sorted(r["i"]) == [1, 3] and r["u"] == [1, 2, 3] and r["txt"] == "1|3"


def test_bit_helpers(spark):
    df = spark.createDataFrame([(0,), (63,), (64,), (130,)], "t bigint")
    got = [(r["w"], r["m"]) for r in
           df.select(CF.bit_word("t").alias("w"), CF.bit_mask("t").alias("m")).collect()]
    assert got == [(0, 1), (0, -(1 << 63)), (1, 1), (2, 4)]
    bits = df.select(F.lit("x").alias("item"), F.col("t").alias("tid"))
    words = {r["word"]: r["bits"] for r in tid_bitsets(bits, dense=False).collect()}
    assert words == {0: 1 | -(1 << 63), 1: 1, 2: 4}
    assert spark.createDataFrame([(-1,)], "b bigint").select(CF.popcount("b")).first()[0] == 64


def test_retail_time(spark):
    df = spark.createDataFrame([("12/01/2010 08:26:00",), ("2010-12-01",), ("13/45/2010 08:26:00",)],
                               "d string")
    got = [r[0] for r in df.select(CF.retail_time("d")).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def test_baskets_profile_and_order(spark):
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 3), (2, "c", 1)],
                                 "tid bigint, item string, ts int")
    assert {r["tid"]: r["items"] for r in to_baskets(rows).collect()} == \
        {1: ["a", "b"], 2: ["c"]}
    assert {r["tid"]: r["items"] for r in ordered_baskets(rows, "tid", "item", ["ts"]).collect()} \
        == {1: ["a", "b", "a"], 2: ["c"]}
    p = profile(rows).first().asDict()
    assert p == {"n_rows": 4, "n_baskets": 2, "n_items": 3, "n_basket_items": 3, "max_basket": 2}
    assert keep_baskets(rows.dropDuplicates(["tid", "item"]), 2).count() == 2


def test_decode_keeps_order_when_asked(spark):
    d = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "item string, item_id bigint")
    sets = spark.createDataFrame([([3, 1], 5)], "itemset array<bigint>, support bigint")
    assert decode(sets, d, sort=False).first()["itemset"] == ["z", "x"]
    assert decode(sets, d, sort=True).first()["itemset"] == ["x", "z"]


def test_min_basket_size_and_partitions(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1)],
                                 "tid bigint, item int")
    assert as_dict(apriori(rows, 2)) == {(1,): 3, (2,): 2, (1, 2): 2}
    assert as_dict(apriori(rows, 2, min_basket_size=2)) == {(1,): 2, (2,): 2, (1, 2): 2}
    assert as_dict(eclat(rows, 2, num_partitions=3)) == as_dict(apriori(rows, 2))


def test_merge_tidsets(spark):
    df = spark.createDataFrame([([1, 2], 0, 5), ([1, 2], 0, 2), ([1, 2], 1, 1), ([3], 0, 1)],
                               "itemset array<int>, word bigint, bits bigint")
    got = {(tuple(r["itemset"]), r["word"]): r["bits"] for r in merge_tidsets(df).collect()}
    assert got == {((1, 2), 0): 7, ((1, 2), 1): 1, ((3,), 0): 1}


def test_finished_intermediate_tables_are_released(spark):
    import os

    from cofreq.session import checkpoint_root, materialize, release

    rows = spark.createDataFrame([(t, i) for t in range(30) for i in range(t % 5 + 1)],
                                 "tid bigint, item int")
    res = apriori(rows, 3)
    before = as_dict(res)
    assert as_dict(res) == before          # the result still reads its level tables
    t = materialize(rows, "scratch")
    path = t._cofreq_path
    root = checkpoint_root(spark)
    local = path[len("file:"):] if path.startswith("file:") else path
    if root.startswith("file:") or root.startswith("/"):
        assert os.path.exists(local)
        release(t)
        assert not os.path.exists(local)
