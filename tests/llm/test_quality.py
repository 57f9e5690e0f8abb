"""Co-training: held-out accuracy, what the exchange adds, awkward rows."""

import numpy as np

from cofreq.llm import quality


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = quality.score_quality(docs, labels)
    assert out.count() == docs.count()
    rows = [r for r in out.join(labels, "doc_id").collect() if r.held_out]
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert auc(y, s) > 0.85
    assert (y == np.array([r.predicted for r in rows])).mean() > 0.9
    # calibrated: mean score near the share of good documents
    assert abs(s.mean() - y.mean()) < 0.05


def _views(n, seed):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.6).astype(int)
    numbers = rng.standard_normal((n, len(quality.CONTENT) + len(quality.LAYOUT)))
    numbers[:, 0] += 2.0 * y
    numbers[:, len(quality.CONTENT)] += 2.5 * y
    return numbers, np.zeros((n, 2), int), y


def test_views_teach_each_other(monkeypatch):
    a, n1, y = _views(60, 1)
    pool, n2, _ = _views(3000, 2)
    test, n3, z = _views(2000, 3)
    with_pool = quality.cotrain(a, n1, y, pool, n2)
    monkeypatch.setattr(quality, "ROUNDS", 0)
    alone = quality.cotrain(a, n1, y, pool, n2)
    better = [auc(z, m) for m in with_pool.margins(test, n3)]
    worse = [auc(z, m) for m in alone.margins(test, n3)]
    assert sum(better) > sum(worse) and auc(z, with_pool.scores(test, n3)) > auc(z, alone.scores(test, n3))


def test_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(i, "varied words make one good text here" if i % 3 else "bad bad bad !!! bad bad", "en", None, 0.5) for i in range(60)]
        + [(100, None, None, None, 0.1), (101, "", "en", "s", 0.1), (None, "x", "en", "s", 0.1), (101, "", "en", "s", 0.1),
           (102, "w" * 200_000, "en", "s", 0.0)],
        "doc_id bigint, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (4, None)], "doc_id bigint, quality int")
    out = quality.score_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert by[31].score > 0.5 > by[33].score
    assert len({r.score for r in out if r.doc_id == 101}) == 1
    assert quality.score_quality(docs.where("false"), labels).count() == 0
    assert all(r.score == 0.5 for r in quality.score_quality(docs, labels.where("false")).collect())
