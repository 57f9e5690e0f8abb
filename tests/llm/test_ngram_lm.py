"""The trigram model against a plain one, and its packed structures."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cofreq.llm import common, eliasfano, ngram_lm

END = b" "


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [3, 3, 900], list(range(1000)), [5 ** i % 9973 for i in range(3000)]])
def test_elias_fano_round_trip(values):
    values = np.sort(np.array(values, np.int64))
    seq = eliasfano.EliasFano(eliasfano.encode(values))
    assert (seq.values() == values).all() and [seq.get(i) for i in range(len(values))][::7] == values.tolist()[::7]
    for x in {0, 1, 7, 500, 10**6, *values.tolist()[::50]}:
        assert seq.successor(0, len(values), x) == int(np.searchsorted(values, x))


def test_packed_integers():
    for a in ([], [0], [1, 70000, 2**40 - 1]):
        assert common.unpack(common.pack(np.array(a))).tolist() == a


def plain(grams):
    """p(w1, w2, w3, p1) from dictionaries of counts of (w1, w2, w3) -> n."""
    two, word, tri = Counter(), Counter(), Counter(grams)
    ctx, follows, third = Counter(), defaultdict(set), defaultdict(set)
    for (a, b, c), n in grams.items():
        two[b, c] += n
        word[b] += n
        ctx[a, b] += n
        follows[b].add(c)
        third[a, b].add(c)

    def discount(counts):
        n1, n2 = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
        return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    d2, d3 = discount(two), discount(tri)

    def p(a, b, c, p1):
        if not word[b]:
            return p1
        low = max(two[b, c] - d2, 0) / word[b] + d2 * len(follows[b]) / word[b] * p1
        if not ctx[a, b]:
            return low
        return max(tri[a, b, c] - d3, 0) / ctx[a, b] + d3 * len(third[a, b]) / ctx[a, b] * low
    return p


def test_trie_against_dictionaries(tmp_path):
    rng = np.random.default_rng(1)
    w = np.minimum(rng.zipf(1.4, (4000, 3)), 40)
    times = rng.integers(1, 4, 4000)
    grams = Counter()
    for row, n in zip(w.tolist(), times.tolist()):
        grams[tuple(row)] += n
    raw = ngram_lm.build_trie(*w.T, times)
    p = plain(grams)
    asked = np.concatenate([w[::9], rng.integers(0, 50, (500, 3))])
    p1 = rng.random(len(asked))
    want = np.array([p(*map(int, q), x) for q, x in zip(asked, p1)])
    trie = ngram_lm.Trie(raw)
    got = trie.probabilities(*asked.T, p1)
    assert np.allclose(got, want, rtol=2e-3)
    (tmp_path / "trie").write_bytes(raw)
    mapped = ngram_lm.Trie.open(str(tmp_path / "trie"))
    for q, x, y in list(zip(asked.tolist(), p1, got))[::11]:
        assert math.isclose(mapped.probability(*q, x), y, rel_tol=1e-9)
    # probabilities of all words after a context add up to one
    v = 60
    for a, b in w[:40, :2]:
        assert abs(trie.probabilities(*(np.full(v, z) for z in (a, b)), np.arange(v), np.full(v, 1 / v)).sum() - 1) < 3e-3
    none = np.zeros(0, np.int64)
    assert ngram_lm.Trie(ngram_lm.build_trie(none, none, none, none)).probabilities(*asked.T, p1).tolist() == p1.tolist()


def test_trie_of_some_of_a_words_trigrams():
    """Counts of the whole corpus stand in for what a shard lacks, to the last bit."""
    rng = np.random.default_rng(3)
    w1, w3 = rng.integers(1, 12, (2, 3000)) ** 2 % 90
    w2, times = np.full(3000, 5), rng.integers(1, 3, 3000)
    tri = np.unique(np.stack([w1, w3], 1), axis=0, return_inverse=True)
    count = lambda a: (np.unique(a), np.bincount(np.unique(a, return_inverse=True)[1], times).astype(np.int64))
    (after, n_after), (before, n_before) = count(w3), count(w1)
    thirds = np.array([(tri[0][:, 0] == b).sum() for b in before])
    rare = (3, 4, *ngram_lm._rare(np.bincount(tri[1].ravel(), times)))
    full = ngram_lm.Trie(ngram_lm.build_trie(w1, w2, w3, times, rare))
    p1 = rng.random(3000)
    want = full.probabilities(w1, w2, w3, p1)
    for mine in ((w1 + w3) % 3 == 0, np.zeros(3000, bool)):
        for b, a in ((np.ones(len(before), bool), np.ones(len(after), bool)), (before < 0, after < 0)):
            whole = (5, int(times.sum()), len(after), after[a], n_after[a], before[b], n_before[b], thirds[b])
            if mine.any() and not b.any():
                continue
            trie = ngram_lm.Trie(ngram_lm.build_trie(w1[mine], w2[mine], w3[mine], times[mine], rare, whole))
            got = trie.probabilities(w1, w2, w3, p1)
            if b.any():
                assert (got[mine] == want[mine]).all()
            else:  # words that follow it nowhere
                assert np.allclose(got, ngram_lm._discount(3, 4) * len(after) / times.sum() * p1, rtol=1e-3)


def brute(rows):
    tokens = [[*(t or "").encode().lower().split(), END] for _, t in rows]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows]
    count, grams = Counter(), Counter()
    for ws, h in zip(tokens, held):
        if not h:
            count.update(ws)
    n, v = sum(count.values()), len(count)
    number = {w: i + 1 for i, w in enumerate(count)}
    sequences = [[number.get(w, 0) for w in ws] for ws in tokens]
    for s, h in zip(sequences, held):
        if not h:
            grams.update(zip([-1] + s, s, s[1:]))
    p = plain(grams)
    out = []
    for (i, _), ws, s, h in zip(rows, tokens, sequences, held):
        p1 = [(count[w] + 0.5) / (n + 0.5 * (v + 1)) for w in ws]
        score = [p1[0]] + [x if not b else p(a, b, c, x) for a, b, c, x in zip([-1] + s, s, s[1:], p1[1:])]
        out.append((i, h, len(ws), sum(count[w] > 0 for w in ws), n, sum(map(math.log10, p1)), sum(map(math.log10, score))))
    return out


def compare(got, want):
    # a code is within 2 ** (1 / 4096) of its value: at most 1e-4 in a token's log10
    order = lambda r: (repr(r[0]), r[2], r[5])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], abs_tol=1e-4 * g[2])


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id bigint, text string, words int, batch string")
    return list(map(tuple, ngram_lm.score_documents(df, **kw).collect()))


@pytest.mark.parametrize("batch", [40, 10**6])
def test_scores_against_a_plain_model(spark, batch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"W{min(int(rng.paretovariate(0.8)), 90)}" for _ in range(rng.randint(0, 25)))) for i in range(120)]
    compare(run(spark, rows, batch=batch), brute(rows))


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "a\tA a"), (3, "a\tA a"), (None, "a b"), (None, None), (4, "x " * 30000), (5, "é É ")]
    rows += [(i, "hot copy of a text") for i in range(50, 90)]
    compare(run(spark, rows, batch=100), brute(rows))
    assert run(spark, []) == []
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    assert run(spark, [(one, "a b")]) == [(one, True, 3, 0, 0, 0.0, 0.0)]


def test_hot_words_are_dealt_and_the_model_predicts_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for shard in (ngram_lm.SHARD, 5000):
        got = [r for r in ngram_lm.score_documents(docs, shard=shard).collect() if r.held_out]
        assert sum(r.score for r in got) > 0.85 * sum(r.base_score for r in got)
    again = {r.doc_id: r.score for r in ngram_lm.score_documents(docs, shard=5000).collect() if r.held_out}
    assert again == {r.doc_id: r.score for r in got}


def test_scores_do_not_follow_how_n_grams_are_dealt(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.7)), 60)}" for _ in range(rng.randint(0, 40)))) for i in range(150)]
    rows += [(i, "w1 w2 w1 " * 30) for i in range(150, 160)]
    one = run(spark, rows)
    compare(one, brute(rows))
    # hot words in many shards, texts in many batches: not one digit changes
    for kw in ({"shard": 40}, {"shard": 300, "batch": 200}):
        assert sorted(run(spark, rows, **kw)) == sorted(one)


def words_of(texts):
    out = []
    for found, ends, lower in ngram_lm._cut(texts):
        words = [w.as_buffer().to_pybytes() for w in found]
        out += [(t, words[a:b]) for t, a, b in zip(lower, [0, *ends], ends)]
    return out


def test_words_are_those_of_bytes(monkeypatch):
    rng = random.Random(5)
    some = [bytes([i]) for i in range(256)] + [b" ", b"\n", b"\x0b", b"a", b"Z"] * 30
    texts = [b"".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(500)] + [b"", b" ", b"\x1c \x85\xa0", b"x" * 3000]
    for kind in (pa.binary(), pa.large_binary()):
        for size in (ngram_lm.TEXT_BYTES, 100):
            monkeypatch.setattr(ngram_lm, "TEXT_BYTES", size)
            for part in (pa.array(texts, kind), pa.array(texts, kind).slice(100, 50), pa.array([], kind)):
                assert words_of(part) == [(t.lower(), t.lower().split()) for t in part.to_pylist()]


def test_batches_take_less_time_than_words_one_by_one():
    rng = np.random.default_rng(6)
    words = [b"w%d" % i for i in range(90_000)]
    texts = [b" ".join(words[i] for i in row) for row in np.minimum(rng.zipf(1.2, (1500, 600)), 90_000) - 1]
    n = len(texts)
    table = pa.record_batch([pa.array(range(n)), pa.array([False] * n), pa.array(texts, pa.binary())], names=["doc_id", "held", "text"])

    def one_by_one():
        number = {}
        for _ in range(2):
            for t in texts:
                np.array([number.setdefault(w, len(number)) for w in t.lower().split()], np.int32)

    def seconds(work):
        out = []
        for _ in range(3):
            start = time.process_time()
            work()
            out.append(time.process_time() - start)
        return min(out)
    # as a batch also sorts, hashes and packs: less than numbering alone takes twice
    assert seconds(lambda: list(ngram_lm._batches(10**6, 1)(iter([table])))) < seconds(one_by_one)


def test_a_trie_is_asked_each_n_gram_once_and_in_order(monkeypatch):
    asked = []
    plainly = ngram_lm.Trie.probabilities
    monkeypatch.setattr(ngram_lm.Trie, "probabilities", lambda self, *a: asked.append(np.stack(a[:3], 1)) or plainly(self, *a))
    uni = ngram_lm._Unigrams([(9, 40)])
    rng = np.random.default_rng(7)
    rows = []
    for batch in range(3):
        w1, w2, w3 = rng.integers(1, 9, (3, 2000))
        text = np.sort(rng.integers(0, 5, 2000))
        rows.append((0, batch, *(common.pack(a) for a in (text, w1, w2, w3, np.array([1, 0, 2, 1, 3]))), *[None] * 7))
    table = pa.Table.from_batches([ngram_lm._record(ngram_lm._SENT, r) for r in rows])
    counted = pa.table({"rare": pa.array([[1, 1, 1, 1]], pa.list_(pa.int64())), "keys": pa.array([None], pa.binary())})

    class Shared:
        value = uni, ngram_lm._Shards(100, [], 10**6)
    got = ngram_lm._answer(Shared)(table, counted)
    assert [common.unpack(t.as_py()).tolist() for t in got.column("text")] == [list(range(5))] * 3
    grams = [(b, a, c) for a, b, c in asked[0].tolist()]
    assert len(asked) == 1 and grams == sorted(set(grams))


def test_sorted_keys_are_numbered_like_others():
    rng = np.random.default_rng(8)
    for keys in (np.zeros(0, np.int64), np.array([4]), np.array([1, 1, 2]), np.sort(rng.integers(0, 50, 300)), rng.integers(0, 50, 300)):
        for got, want in zip(ngram_lm._distinct(keys), np.unique(keys, return_inverse=True)):
            assert got.tolist() == want.tolist()
