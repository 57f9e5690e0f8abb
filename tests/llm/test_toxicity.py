"""Positive-unlabelled toxicity: held-out accuracy and awkward rows."""

import zlib

import numpy as np

from cofreq.llm import toxicity
from cofreq.llm.textfeatures import Rows

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.score_toxicity(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    assert out.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out]
    y = np.array([r.toxic for r in test])
    flagged = np.array([r.predicted for r in test], dtype=bool)
    assert y[flagged].mean() > 0.95 and flagged[y == 1].mean() > 0.6


def test_only_unheld_labels_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, flipped).collect()}
    assert a == b


def test_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(i, f"you scum number {i % 7} of it", 1.0) for i in range(0, 60, 2)]
        + [(i, f"a kind word number {i % 7} of it", 0.0) for i in range(1, 300, 2)]
        + [(1000, None, 0.0), (1001, "", 0.0), (None, "you scum of it", 0.0), (1001, "", 0.0), (1002, "x" * 100_000, 0.0)],
        "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, 1, "a") for i in range(0, 30, 2)] + [(i, 0, "a") for i in range(1, 160, 2)]
                                   + [(None, 1, "a"), (5, None, "a"), (9, 0, "a")], "doc_id bigint, toxic int, text string")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out}
    assert by[1000].score == by[1001].score and by[1000].predicted == 0
    assert by[40].score > 0.5 > by[211].score and by[None].score > 0.5 and not by[None].held_out
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    none = docs.where("false")
    assert toxicity.score_toxicity(none, labels).count() == 0
    quiet = toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in quiet)


def test_negative_risk_is_pushed_back():
    rng = np.random.default_rng(0)
    pos = Rows([np.unique(np.r_[1, rng.integers(10, 60, 5)]).astype(np.int32) for _ in range(200)])
    mixed = Rows([np.unique(np.r_[[1] if i % 5 == 0 else [2], rng.integers(10, 60, 5)]).astype(np.int32) for i in range(1000)])
    m = toxicity.fit(pos, mixed, 0.2)
    s = 1 / (1 + np.exp(-(mixed.margins(m.weights) + m.bias)))
    assert s[::5].min() > 0.7 and np.delete(s, np.s_[::5]).max() < 0.5
    clean = np.logaddexp(0, mixed.margins(m.weights) + m.bias).mean() - 0.2 * np.logaddexp(
        0, pos.margins(m.weights) + m.bias).mean()
    assert clean > -0.05


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    free = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = spark.createDataFrame([(free, f"copy {n % 3}") for n in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(free, 1, 1)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda positive, unlabelled, prior: seen.append((positive, unlabelled)))
    toxicity.train(docs, labels)
    assert [len(r) for r in seen[0]] == [1, 1]


def test_picks_are_the_smallest_hashes(spark):
    """The limit on hashes that goes first changes no pick."""
    from pyspark.sql import functions as F

    from cofreq.llm.common import smallest_hashes
    ids = spark.range(20000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    want = {r.doc_id for r in ids.orderBy("h", "doc_id").limit(300).collect()}
    assert {r.doc_id for r in smallest_hashes(ids, 20000, 300).collect()} == want
    assert smallest_hashes(ids, 20000, 20000).count() == 20000
    assert smallest_hashes(ids.where("false"), 0, 300).count() == 0
