"""Packing: an exact round trip of all ids, gapless sequences, and the mixture."""

from collections import defaultdict
from zlib import crc32

import numpy as np

from cofreq.llm import packing
from cofreq.llm.tokens import tokenizer_path


def _ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def check(rows, pieces, sequence=packing.SEQUENCE):
    """rows: (doc_id, text); doc ids may repeat with equal texts only."""
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for s, parts in seqs.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= sequence and (at == sequence or s == len(seqs) - 1)
    want = defaultdict(list)
    for (doc_id, _), ids in zip(rows, _ids([t for _, t in rows])):
        want[doc_id].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for doc_id, lists in want.items():
        ids, n = lists[0], len(lists)
        assert sum(p.length for p in got[doc_id]) == n * len(ids)
        covered = np.zeros(len(ids), int)
        for p in got[doc_id]:
            assert p.doc_tokens == len(ids)
            part = ids[p.start:p.start + p.length]
            assert crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
            covered[p.start:p.start + p.length] += 1
        assert (covered == n).all()


def test_whole_table_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, packing.packed_pieces(docs).collect())


def test_windows_hold_the_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = packing.pack(docs).select("source", "length", "sequence_id").toPandas()
    share = out.groupby("source").length.sum() / out.length.sum()
    per = packing.WINDOW // packing.SEQUENCE
    out["window"] = out.sequence_id // per
    by = out.groupby(["window", "source"]).length.sum().unstack(fill_value=0)
    full = by[by.sum(axis=1) == packing.WINDOW]
    assert len(full) > 50
    mean_error = (full.cumsum().div(full.cumsum().sum(axis=1), axis=0) - share).abs().iloc[20:].max().max()
    assert mean_error < 0.03


def test_awkward_rows(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, None), (3, "", "t"), (None, "null id", None),
            (4, "word " * 5000, "s"), (5, "  odd\t\tspace ", "t")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, source string, rid int, place int")
    check([r[:2] for r in rows], packing.packed_pieces(docs).collect())
    ids = packing.pack(docs).select("length", "ids", "ids_crc32").collect()
    assert all(len(r.ids) == 4 * r.length and crc32(bytes(r.ids)) == r.ids_crc32 for r in ids)
    assert packing.packed_pieces(docs.where("false")).count() == 0


def serial(order, quantum):
    """Row ids by a plain deficit round-robin over queues in ``order``, with
    the round of each."""
    queues = {s: [r for r in order if r[1] == s] for s in sorted(quantum)}
    stream, deficit, turn = [], dict.fromkeys(queues, 0.0), 0
    while any(queues.values()):
        turn += 1
        for s, queue in queues.items():
            deficit[s] += quantum[s]
            while queue and queue[0][2] <= deficit[s] + 1e-6:
                r = queue.pop(0)
                deficit[s] -= r[2]
                stream.append((r[0], turn))
    return stream


def _rows(seed, sources):
    import random
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.randint(1, 400)) for i in range(600)]


def _layout(spark, rows, targets=None):
    df = spark.createDataFrame(rows, "rid bigint, source string, n bigint")
    if targets is not None:
        targets = spark.createDataFrame(targets, "source string, weight double")
    place = {r.rid: r.place for r in packing.layout(df, 1000, targets).collect()}
    order = sorted(rows, key=lambda r: place[r[0]])
    at = 0
    for r in order:
        assert place[r[0]] == at
        at += r[2]
    return order


def test_deficits_in_closed_form(spark, monkeypatch):
    """The windows of documents are those of a serial deficit round-robin."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 5)
    rows = _rows(1, "aab")
    order, total = _layout(spark, rows), sum(r[2] for r in rows)
    quantum = {s: 1000 * sum(r[2] for r in rows if r[1] == s) / total for s in "ab"}
    assert [x for x, _ in serial(order, quantum)] == [r[0] for r in order]


def test_chosen_targets(spark):
    """Windows follow the targets until a queue ends, then the others' ones;
    a source without a target keeps its share."""
    rows = _rows(2, "aaabbc")
    order, total = _layout(spark, rows, [("a", 1.0), ("b", 3.0), ("none", 5.0)]), sum(r[2] for r in rows)
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in "abc"}
    both = (size["a"] + size["b"]) / total
    quantum = {"a": 250 * both, "b": 750 * both, "c": 1000 * size["c"] / total}
    stream = serial(order, quantum)
    assert [x for x, _ in stream] == [r[0] for r in order]
    by_id = {r[0]: r for r in rows}
    end = max(t for x, t in stream if by_id[x][1] == "b")
    sent = dict.fromkeys("abc", 0)
    for x, t in stream:
        if t < end:
            sent[by_id[x][1]] += by_id[x][2]
    # a deficit is always less than the largest document
    assert all(abs(sent[s] - (end - 1) * quantum[s]) <= 400 for s in "abc")
    assert max(t for _, t in stream) > end  # others go on


def test_targets_that_cannot_be(spark):
    import pytest
    rows = _rows(3, "ab")
    for wrong in ([("a", 0.0)], [("a", None)], [("a", 1.0), ("a", 2.0)]):
        with pytest.raises(ValueError):
            _layout(spark, rows, wrong)
