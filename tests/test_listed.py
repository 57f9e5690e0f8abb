"""Joins with lists beyond the broadcast limit: a Bloom filter goes ahead."""

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from cofreq import apriori, eclat, r_apriori, session
from cofreq.operators import listed
from cofreq.operators.listed import bloom_prefilter, join_listed
from cofreq.operators.support import trim_baskets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows(spark):
    return spark.range(60_000).select((F.col("id") % 7001).alias("tid"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("item"))


@pytest.mark.parametrize("kind", ["bigint", "string", "int", "date"])
def test_few_other_rows_pass_and_no_wanted_one_is_lost(spark, rows, kind):
    def typed(df):
        item = F.col("item")
        return df.withColumn("item", F.date_add(F.lit("2020-01-01"), item.cast("int")) if kind == "date" else item.cast(kind))
    keys = typed(spark.range(0, 20_000, 10).select(F.col("id").alias("item")))
    own = typed(rows)
    kept = own.join(F.broadcast(keys), "item", "left_semi").count()
    passed = bloom_prefilter(own, keys, ["item"], keys.count())
    assert passed.columns == own.columns
    assert passed.join(keys, "item", "left_semi").count() == kept
    assert kept <= passed.count() < kept + 0.08 * (own.count() - kept)
    # rows are tested where they lie, before any shuffle
    assert "hashpartitioning(item" not in plan(passed) and "BroadcastHashJoin" in plan(passed)


@pytest.mark.parametrize("how", ["left_semi", "inner"])
def test_same_rows_as_a_plain_join(spark, rows, how):
    listed_ = spark.range(0, 20_000, 7).select(F.col("id").alias("item"), (F.col("id") % 5).alias("tid"), F.lit("x").alias("name"))
    for on in ("item", ["tid", "item"]):
        got = join_listed(rows, listed_, on, how, limit=0)
        want = rows.join(listed_, on, how)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        join_listed(rows, listed_, "item", "left")


def test_awkward_keys(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a"), (4, "b" * 100_000)], "tid int, item string")
    keys = spark.createDataFrame([("",), (None,), ("a",), ("a",)], "item string")
    assert sorted(r.tid for r in join_listed(rows, keys, "item", limit=0).collect()) == [2, 3, 3]
    assert join_listed(rows, keys.limit(0), "item", limit=0).count() == 0
    assert join_listed(rows.limit(0), keys, "item", limit=0).count() == 0


def test_no_filter_where_it_cannot_help_or_hashes_differ(spark, rows, monkeypatch):
    keys = spark.range(100).select(F.col("id").alias("item"))
    assert bloom_prefilter(rows, keys.select(F.col("item").cast("int")), ["item"], 100) is rows
    floats = rows.select("tid", F.col("item").cast("double"))
    assert bloom_prefilter(floats, keys.select(F.col("item").cast("double")), ["item"], 100) is floats
    monkeypatch.setattr(listed, "MAX_WORDS", 2)
    assert bloom_prefilter(rows, keys, ["item"], 100) is rows
    few = bloom_prefilter(rows, keys, ["item"], 60)  # two words at two bits a key
    assert few is not rows and few.join(keys, "item", "left_semi").count() == rows.where("item < 100").count()


def test_trim_shuffles_about_the_kept_rows(spark, rows):
    keys = spark.range(0, 20_000, 10).select(F.col("id").alias("item"))
    assert sorted(map(tuple, trim_baskets(rows, keys, 2, limit=0).collect())) == \
        sorted(map(tuple, trim_baskets(rows, keys, 2).collect()))


def test_miners_without_broadcast(spark, monkeypatch):
    rows = spark.range(4000).select((F.col("id") % 300).alias("tid"), F.concat(F.lit("i"), F.pmod(F.xxhash64("id"), F.lit(25))).alias("item"))
    want = as_dict(apriori(rows, 25, max_len=3))
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 0)
    for found in (apriori(rows, 25, max_len=3), apriori(rows, 25, max_len=3, strategy="extend"),
                  eclat(rows, 25, max_len=3), r_apriori(rows, 25)):
        assert as_dict(found) == want
