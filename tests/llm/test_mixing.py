"""The mix against plain water-filling and its own SQL, with awkward rows."""

import duckdb

from cofreq.llm import mixing
from tests.llm.test_pipeline import targets


def _docs(spark):
    rows = [(i, "w " * (i % 13), ["a", "b", None, "c\U0001F600", "c￿"][min(i % 9, 4)], 1) for i in range(400)]
    rows += [(7, "same text", "a", 2), (7, "same text", "a", 2), (None, "x y", "a", 3), (None, None, None, 3),
             (900, "big " * 4000, "huge", 1), (901, "", "empty", 1), (902, None, "empty", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")


def test_targets_and_takes(spark):
    docs = _docs(spark)
    out = mixing.mix_documents(docs).collect()
    assert len(out) == docs.count()
    src = {}
    for r in docs.collect():
        src[r.source] = src.get(r.source, 0) + len((r.text or "").split())
    want = targets(src)
    got, taken = {}, {}
    by_size = {s: n for s, n in src.items()}
    sources = {(r.doc_id, len((r.text or "").split())): r.source for r in docs.collect()}
    for r in out:
        s = sources[r.doc_id, r.size]
        got[s] = r.target
        assert r.source_size == by_size[s] and r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert all(abs(taken[s] - want[s]) <= 4000 for s in want)
    assert abs(taken["b"] - want["b"]) <= 13
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_documents(docs).collect()))


def test_sql_agrees(spark):
    docs = _docs(spark).where("doc_id is not null")
    arrow = docs.toArrow()
    con = duckdb.connect()
    con.register("documents", arrow)
    want = sorted(con.execute(mixing.ORACLE).fetchall(), key=str)
    got = sorted((tuple(r) for r in mixing.mix_documents(docs).collect()), key=str)
    assert [w[:3] + w[4:] for w in want] == [g[:3] + g[4:] for g in got]
    assert all(abs(w[3] - g[3]) < 1e-6 for w, g in zip(want, got))


def test_mixed_rows_follow_the_plan(spark):
    docs = _docs(spark)
    out = mixing.mixed(docs)
    assert out.schema == docs.schema
    n = {}
    for r in out.collect():
        n[r.doc_id, len((r.text or "").split())] = n.get((r.doc_id, len((r.text or "").split())), 0) + 1
    plan = {}
    for r in mixing.mix_documents(docs).collect():
        if r.taken:
            plan[r.doc_id, r.size] = plan.get((r.doc_id, r.size), 0) + r.taken // r.size
    assert n == plan


def test_empty(spark):
    docs = _docs(spark).where("false")
    assert mixing.mix_documents(docs).count() == 0 and mixing.mixed(docs).count() == 0


def test_id_on_a_third_of_the_rows(spark, monkeypatch):
    """A bucket that one id fills is cut, and the mix stays that of the SQL."""
    rows = [(i, "w " * (i % 13 + 1), "ab"[i % 2]) for i in range(200)] + [(7, "w " * (i % 4 + 1), "a") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted(con.execute(mixing.ORACLE).fetchall(), key=str)
    monkeypatch.setattr(mixing, "HOT_ROWS", 20)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    got = sorted((tuple(r) for r in mixing.mix_documents(docs).collect()), key=str)
    assert [w[:3] + w[4:] for w in want] == [g[:3] + g[4:] for g in got]
