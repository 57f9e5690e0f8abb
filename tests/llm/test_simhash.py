"""SimHash groups against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest

from cofreq.llm import simhash


def _groups(fps, radius=3):
    """Smallest index reachable, by brute force."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(fps)), 2):
            if bin(fps[i] ^ fps[j]).count("1") <= radius and low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                changed = True
    return low


def _plain(text, ngram):
    import xxhash
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x)
         for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return 0
    sh = [" ".join(w[i:i + ngram]) for i in range(max(1, len(w) - ngram + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_matches_definition():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50):
        t = " ".join(rng.choice(["Aa", "ÄB", "c d", "x"]) for _ in range(n))
        assert simhash.fingerprint(t) == _plain(t, 3)
    assert simhash.fingerprint(None) == 0
    assert simhash.fingerprint("A\tb\n C") == simhash.fingerprint("a b c")


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_pair_within_radius_shares_a_variant(distance):
    rng = random.Random(distance)
    for _ in range(60):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), distance):
            b ^= 1 << bit
        keys = [set(simhash._variants(np.array([x], dtype=np.uint64))[0].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_links_and_components(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = list(base)
    for x in base[:15]:
        for _ in range(6):
            y = x
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << bit
            fps.append(y)
    chain = base[20]
    for bit in range(12):
        chain ^= 1 << bit
        fps.append(chain)
    fps = sorted(set(fps))
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    got = {r.fingerprint: r.root for r in simhash.fingerprint_groups(
        spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")).collect()}
    low = _groups(fps)
    assert len(got) == len(fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (low[i] == low[j]) == (got[signed[i]] == got[signed[j]])


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, part int")


def test_components_on_awkward_rows(spark):
    words = [f"w{i}" for i in range(300)]
    near = words[:]
    near[150] = "other"
    rows = [(5, " ".join(words), "x", 1), (3, " ".join(near), None, None), (9, " ".join(words), "", 2),
            (9, " ".join(words), "", 2), (None, " ".join(words), "", 2), (7, "", "", 0),
            (8, None, "", 0), (11, "Lonely words here now", "", 0)]
    out = simhash.simhash_components(_docs(spark, rows)).collect()
    fps = [simhash.fingerprint(r[1]) for r in rows]
    low = _groups(fps)
    want = []
    for i, r in enumerate(rows):
        ids = [q[0] for k, q in enumerate(rows) if low[k] == low[i] and q[0] is not None]
        want.append((r[0], f"{fps[i]:016x}", min(ids)))
    key = str
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert simhash.simhash_components(_docs(spark, [])).count() == 0


def test_keep_one_keeps_columns_and_one_row(spark):
    rows = [(5, "a b c d", "x", 1), (2, "A b c d", "y", 2), (2, "A b c d", "y", 2),
            (None, "a b c d", "z", 3), (6, "quite another text", None, None), (7, None, "n", 1)]
    out = simhash.keep_one(_docs(spark, rows))
    assert out.columns == ["doc_id", "text", "fingerprint", "part"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(2, "A b c d", "y", 2), (6, "quite another text", None, None), (7, None, "n", 1)], key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [simhash.fingerprint(r.text) for r in rows]
    low = _groups(fps)
    out = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    for i, r in enumerate(rows):
        assert out[r.doc_id].fingerprint == f"{fps[i]:016x}"
        assert out[r.doc_id].component_id == min(rows[k].doc_id for k in range(len(rows)) if low[k] == low[i])
