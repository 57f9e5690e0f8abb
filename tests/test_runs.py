"""Runs that resume, tables counted while written, layouts that last, decoding."""

import random
import uuid

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from cofreq import apriori, r_apriori, session
from cofreq.operators.eclat import (bitmap_support, eclat, merge_bitmaps, tid_bitmaps)
from cofreq.operators.encode import decode
from cofreq.operators.groupjoin import pairs_within
from cofreq.operators.ordered import ordered_patterns
from cofreq.operators.support import prepare
from cofreq.sources import read_itemsets, write_itemsets


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    return spark.createDataFrame([(t, f"i{i}") for t in range(120) for i in range(9) if rng.random() < 0.6],
                                 "tid bigint, item string").persist()


class Stopped(Exception):
    pass


@pytest.mark.parametrize("strategy", ["pairs", "extend"])
def test_a_lost_driver_resumes(spark, rows, tmp_path, monkeypatch, strategy):
    whole = as_dict(apriori(rows, 20, strategy=strategy))
    write, done = session.Store.write, []

    def until(last):
        def run(self, df, tag, *a):
            if tag == last:
                raise Stopped
            if not self._note(tag):
                done.append(tag)
            return write(self, df, tag, *a)
        return run
    folder = str(tmp_path / "run")
    monkeypatch.setattr(session.Store, "write", until("candidates-4"))
    with pytest.raises(Stopped):
        apriori(rows, 20, strategy=strategy, resume=folder)
    assert done == ["rows", "items", "coded-rows", "candidates-2", "level-2", "candidates-3", "level-3"]
    done.clear()
    monkeypatch.setattr(session.Store, "write", until(None))
    assert as_dict(apriori(rows, 20, strategy=strategy, resume=folder)) == whole
    assert done[:2] == ["candidates-4", "level-4"]
    done.clear()
    assert as_dict(apriori(rows, 20, strategy=strategy, resume=folder, report="exact_k", k=3)) == \
        {s: n for s, n in whole.items() if len(s) == 3}
    assert done == []
    with pytest.raises(ValueError, match="other parameters"):
        apriori(rows, 21, strategy=strategy, resume=folder)


def test_eclat_resumes(spark, rows, tmp_path, monkeypatch):
    whole = as_dict(eclat(rows, 20))
    write, done = session.Store.write, []

    def until(last):
        def run(self, df, tag, *a):
            if tag == last:
                raise Stopped
            if not self._note(tag):
                done.append(tag)
            return write(self, df, tag, *a)
        return run
    folder = str(tmp_path / "run")
    monkeypatch.setattr(session.Store, "write", until("candidates-4"))
    with pytest.raises(Stopped):
        eclat(rows, 20, resume=folder)
    assert done == ["rows", "bitsets", "level-1", "tids-1", "level-2", "tids-2", "candidates-3", "level-3", "tids-3"]
    done.clear()
    monkeypatch.setattr(session.Store, "write", until(None))
    assert as_dict(eclat(rows, 20, resume=folder)) == whole
    assert done[:2] == ["candidates-4", "level-4"]
    with pytest.raises(ValueError, match="other parameters"):
        eclat(rows, 21, resume=folder)


def test_miners_leave_nothing_on_executors(spark, rows):
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    r_apriori(rows, 20).count()
    eclat(rows, 20).count()
    apriori(rows, 20).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held


def test_an_unfinished_table_is_written_again(spark, tmp_path):
    store = session.Store(spark, str(tmp_path / "s"))
    spark.range(3).write.parquet(str(tmp_path / "s" / "t"))
    df, n = store.write(spark.range(5), "t")
    assert n == 5 and df.count() == 5
    again, n = session.Store(spark, str(tmp_path / "s")).write(spark.range(7), "t")
    assert n == 5 and again.schema.simpleString() == "struct<id:bigint>" and again.count() == 5


def jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_written_rows_are_counted_by_the_same_job(spark):
    store = session.Store(spark)
    plain = jobs(spark, lambda: session.materialize(spark.range(100), "plain"))
    counted = []
    assert jobs(spark, lambda: counted.append(store.write(spark.range(100), "counted"))) == plain
    assert counted[0][1] == 100
    assert store.write(spark.range(0), "none")[1] == 0
    assert store.write(spark.range(9).where("id > 50 and rand() > 2"), "none")[1] == 0


def test_bucketed_rows_join_without_a_shuffle(spark, rows):
    prep = prepare(rows, 2, num_partitions=5)
    assert as_dict(apriori(rows, 30, num_partitions=5)) == as_dict(eclat(rows, 30, num_partitions=3)) == \
        as_dict(apriori(rows, 30))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = pairs_within(prep.rows, ["tid"], "item", check_hot=False)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert pairs.count() == pairs_within(rows, ["tid"], "item", check_hot=False).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    name = prep.rows._cofreq_table
    session.release(prep.rows)
    assert not spark.catalog.tableExists(name)


def test_ordered_patterns_hash(spark, rows, monkeypatch):
    plans = []
    write = session.Store.write

    def seen(self, df, tag, *a):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, tag, *a)
    monkeypatch.setattr(session.Store, "write", seen)
    timed = rows.withColumn("ts", F.xxhash64("tid", "item"))
    assert ordered_patterns(timed, 20, order=["ts"], max_len=3).count() > 0
    assert plans and not any("SortAggregate" in p for p in plans)


def test_decode_keeps_rows_apart(spark):
    names = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "item_id bigint, item string")
    sets = spark.createDataFrame([([1, 2], 2, 5, "x"), ([1, 2], 2, 5, "x"), ([], 0, 9, None), (None, 0, 1, "n"), ([3], 1, 4, "y")],
                                 "itemset array<bigint>, k int, support int, _row string")
    got = sorted(map(tuple, decode(sets, names).collect()), key=repr)
    assert got == sorted([(["a", "b"], 2, 5, "x"), (["a", "b"], 2, 5, "x"), ([], 0, 9, None), (None, 0, 1, "n"), (["c"], 1, 4, "y")], key=repr)
    assert [r.itemset for r in decode(sets.select("itemset").limit(1), names, sort=False).collect()] == [["b", "a"]]
    with pytest.raises(Exception, match="not in the dictionary"):
        decode(spark.createDataFrame([([7],)], "itemset array<bigint>"), names).collect()


def test_bitmaps(spark, rows):
    far = rows.unionAll(spark.range(40000).select(F.col("id") + 1000, F.lit("i0")))
    maps = tid_bitmaps(far.unionAll(rows))
    want = {r[0]: r[1] for r in far.groupBy("item").count().collect()}
    assert {r.item: r.support for r in bitmap_support(maps).collect()} == want
    assert maps.where("item = 'i0'").count() == 2  # buckets of 32,768
    merged = merge_bitmaps(maps.withColumn("all", F.lit(1)), ["all"])
    assert bitmap_support(merged, ["all"]).first()["support"] == far.select("tid").distinct().count()


def test_levels_lie_apart(spark, rows, tmp_path):
    found = apriori(rows, 30)
    write_itemsets(found, str(tmp_path / "r"), by_level=True)
    two = read_itemsets(spark, str(tmp_path / "r"), k=2)
    assert as_dict(two) == {s: n for s, n in as_dict(found).items() if len(s) == 2}
    assert len(two.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(k" in two._jdf.queryExecution().toString()
    write_itemsets(found, str(tmp_path / "t"), fmt="text", by_level=True)
    assert spark.read.text(str(tmp_path / "t")).where("k = 2").count() == two.count()
