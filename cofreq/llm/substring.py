"""Removing passages that repeat, found by difference-cover anchors.

A difference cover of a period holds, for every distance, two places that far
apart.  If words i.. and j.. of two texts agree over a whole window, there is a
shift below the period that takes both i and j to cover places; the shorter
window there, an anchor, lies inside both matches and has one hash.  So only
anchors at cover places are compared across the corpus (5 of 21 places here),
and a window can repeat only if some anchor in it does.

The matches are then extended: of the windows that hold a repeated anchor,
whole hashes are compared, and those found once only are dropped.

Hashes travel packed, a row per batch of documents and part.  A batch sends a
hash once however often it holds it, marked as a repeat, so a passage that
fills a third of the corpus is as light as any.  What comes back are the items
that occur once; groups of equal passages are never listed.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofreq.llm.common import small_batches
from cofreq.session import materialize

#: Words of a window that counts, and the period of the cover.
WINDOW, PERIOD = 35, 21
#: Items that a part of the exchange aims at.
PART = 500_000
#: Bytes of text per word, on the low side; sets the number of parts only.
BYTES_PER_WORD = 5

_BASE = 0x9E3779B97F4A7C15
_TWICE = np.uint32(1 << 31)


def difference_cover(period: int) -> list[int]:
    """A smallest set of residues whose differences give every residue."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            some = (0, *rest)
            if len({(a - b) % period for a in some for b in some}) == period:
                return list(some)
    raise AssertionError("the full set is a cover")


COVER = np.isin(np.arange(PERIOD), difference_cover(PERIOD))
ANCHOR = WINDOW - PERIOD + 1


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any runs of a list of words: polynomials over 64-bit word
    hashes, modulo 2^64, from prefix sums."""

    def __init__(self, texts: list[list[bytes]]):
        from xxhash import xxh3_128_digest

        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        n = int(self.sizes.sum())
        both = np.frombuffer(b"".join([xxh3_128_digest(w) for t in texts for w in t]), "<u8").reshape(n, 2)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        self.inverse = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        self.inverse = np.cumprod(self.inverse)
        self.sums = [np.concatenate([[np.uint64(0)], np.cumsum(both[:, k] * power[:n])]) for k in (0, 1)]

    def runs(self, at: np.ndarray, length: int, k: int = 0) -> np.ndarray:
        s = self.sums[k]
        return _mixed((s[at + length] - s[at]) * self.inverse[at])


def anchor_places(n_words: int) -> np.ndarray:
    """Places of a text's anchors; none if no window fits."""
    if n_words < WINDOW:
        return np.zeros(0, np.int64)
    at = np.arange(n_words - ANCHOR + 1)
    return at[COVER[at % PERIOD]]


def candidate_starts(n_words: int, repeated: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold any of the anchors ``repeated``."""
    if n_words < WINDOW or not len(repeated):
        return np.zeros(0, np.int64)
    change = np.zeros(n_words + 2, np.int64)
    np.add.at(change, np.maximum(repeated - (PERIOD - 1), 0), 1)
    np.add.at(change, repeated + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:n_words - WINDOW + 1] > 0)


def _to_runs(starts: np.ndarray) -> bytes:
    """Ascending numbers as (first, count) pairs."""
    first = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
    count = np.diff(np.append(first, len(starts)))
    return np.stack([starts[first], count], axis=1).astype("<u4").tobytes()


def _from_runs(data: bytes) -> np.ndarray:
    pairs = np.frombuffer(data, "<u4").reshape(-1, 2).astype(np.int64)
    if not len(pairs):
        return np.zeros(0, np.int64)
    return np.concatenate([np.arange(a, a + n) for a, n in pairs])


_SENT = "part int, batch long, kind int, data binary"
_NAMES = ["part", "batch", "kind", "data"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_NAMES)


def _send(batch: int, parts: int, h: np.ndarray, check: np.ndarray | None, note: bytes) -> pa.RecordBatch:
    """A batch's items by part, each different one once with its ordinal, and
    ``note``, which comes back with what is found."""
    n = len(h)
    order = np.argsort(h, kind="stable") if check is None else np.lexsort((check, h))
    key = h[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    if check is not None:
        other = check[order]
        new[1:] |= other[1:] != other[:-1]
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, n)) > 1
    ordinal = order[first].astype(np.uint32) | np.where(many, _TWICE, np.uint32(0))
    key = key[first]
    part = (key % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    part, key, ordinal = part[by_part], key[by_part], ordinal[by_part]
    extra = None if check is None else check[order][first][by_part]
    cut = [*np.flatnonzero(np.diff(part, prepend=-1)), len(part)]
    rows = [(batch % parts, batch, 1, note)]
    for a, b in zip(cut, cut[1:]):
        data = key[a:b].tobytes() + ordinal[a:b].tobytes() + (b"" if extra is None else extra[a:b].tobytes())
        rows.append((int(part[a]), batch, 0, data))
    return _rows(rows)


def _alone(checked: bool):
    """Of one part: for each batch the ordinals of items that occur once."""
    width = 16 if checked else 12

    def run(table: pa.Table) -> pa.Table:
        batches, kinds, datas = (table.column(c).to_pylist() for c in ("batch", "kind", "data"))
        notes = [(0, b, 1, d) for b, k, d in zip(batches, kinds, datas) if k == 1]
        sent = [(b, d) for b, k, d in zip(batches, kinds, datas) if k == 0]
        rows = list(notes)
        if sent:
            sizes = [len(d) // width for _, d in sent]
            h = np.concatenate([np.frombuffer(d, "<u8", n) for (_, d), n in zip(sent, sizes)])
            ordinal = np.concatenate([np.frombuffer(d, "<u4", n, 8 * n) for (_, d), n in zip(sent, sizes)])
            owner = np.repeat(np.arange(len(sent)), sizes)
            extra = (np.concatenate([np.frombuffer(d, "<u4", n, 12 * n) for (_, d), n in zip(sent, sizes)])
                     if checked else np.zeros(len(h), np.uint32))
            order = np.lexsort((extra, h)) if checked else np.argsort(h, kind="stable")
            h, extra, ordinal, owner = h[order], extra[order], ordinal[order], owner[order]
            equal = np.zeros(len(h) + 1, bool)
            equal[1:-1] = (h[1:] == h[:-1]) & (extra[1:] == extra[:-1])
            single = ~equal[1:] & ~equal[:-1] & (ordinal < _TWICE)
            ordinal, owner = ordinal[single], owner[single]
            order = np.argsort(owner, kind="stable")
            ordinal, owner = ordinal[order], owner[order]
            cut = [*np.flatnonzero(np.diff(owner, prepend=-1)), len(owner)]
            rows += [(0, sent[owner[a]][0], 0, ordinal[a:b].tobytes()) for a, b in zip(cut, cut[1:])]
        if not rows:
            return pa.Table.from_batches([], schema=pa.schema(zip(_NAMES, [pa.int32(), pa.int64(), pa.int32(), pa.binary()])))
        return pa.Table.from_batches([_rows(rows)])

    return run


def _exchange(sent: DataFrame, checked: bool) -> DataFrame:
    return sent.groupBy("part").applyInArrow(_alone(checked), _SENT)


def _returned(table: pa.Table) -> tuple[bytes, np.ndarray]:
    """A batch's note and the ordinals of its items that occur once."""
    note, found = b"", []
    for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()):
        if kind == 1:
            note = data
        else:
            found.append(np.frombuffer(data, "<u4"))
    return note, np.sort(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


def _batch_number(nth: int) -> int:
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 32) + nth


def _anchors(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, b in enumerate(batches):
            texts = [words(t.as_py()) for t in b.column(2)]
            roll = Rolling(texts)
            start = np.concatenate([[0], np.cumsum(roll.sizes)])
            at = [anchor_places(n) + s for n, s in zip(roll.sizes.tolist(), start.tolist())]
            h = roll.runs(np.concatenate(at), ANCHOR) if at else np.zeros(0, np.uint64)
            keys = [b.column(k).to_numpy(zero_copy_only=False).astype("<i8") for k in (0, 1)]
            note = b"".join([*(k.tobytes() for k in keys), roll.sizes.astype("<i8").tobytes()])
            if len(h):
                yield _send(_batch_number(nth), parts, h, None, note)
    return run


def _candidates(table: pa.Table) -> pa.Table:
    """Runs of candidate windows of each document of a batch that has any."""
    note, lonely = _returned(table)
    k1, k2, sizes = np.frombuffer(note, "<i8").reshape(3, -1)
    out, at = [], 0
    for a, b, n in zip(k1.tolist(), k2.tolist(), sizes.tolist()):
        places = anchor_places(n)
        lo, hi = np.searchsorted(lonely, [at, at + len(places)])
        starts = candidate_starts(n, np.delete(places, lonely[lo:hi] - at))
        at += len(places)
        if len(starts):
            out.append((a, b, _to_runs(starts)))
    cols = list(zip(*out)) if out else [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()))],
                    names=["k1", "k2", "runs"])


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without candidate windows are done; the others keep their text."""
    for b in batches:
        doc_id, k1, k2, text, runs = b.columns
        split = [words(t.as_py()) for t in text]
        open_ = [r.is_valid for r in runs]
        yield pa.RecordBatch.from_arrays(
            [doc_id, k1, k2, pa.array([t.as_py() if o else None for t, o in zip(text, open_)], pa.string()), runs,
             pa.array([len(w) for w in split], pa.int64()),
             pa.array([None if o else _digest(w) for w, o in zip(split, open_)], pa.string())],
            names=["doc_id", "k1", "k2", "text", "runs", "n_words", "kept_sha256"])


def _windows(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, b in enumerate(batches):
            if not b.num_rows:
                continue
            roll = Rolling([words(t.as_py()) for t in b.column(2)])
            start = np.concatenate([[0], np.cumsum(roll.sizes)])
            runs = b.column(3).to_pylist()
            at = np.concatenate([_from_runs(r) + s for r, s in zip(runs, start.tolist())])
            check = (roll.runs(at, WINDOW, 1) >> np.uint64(32)).astype("<u4")
            keys = [b.column(k).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for k in (0, 1)]
            size = np.array([len(r) for r in runs], "<i8").tobytes()
            note = struct.pack("<q", len(runs)) + b"".join([*keys, size, *runs])
            yield _send(_batch_number(nth), parts, roll.runs(at, WINDOW), check, note)
    return run


def _refuted(table: pa.Table) -> pa.Table:
    """Starts of the candidate windows that occur once, by document."""
    note, lonely = _returned(table)
    n = struct.unpack_from("<q", note)[0]
    k1, k2, size = np.frombuffer(note, "<i8", 3 * n, 8).reshape(3, n)
    out, at, place = [], 0, 8 + 24 * n
    for a, b, length in zip(k1.tolist(), k2.tolist(), size.tolist()):
        starts = _from_runs(note[place:place + length])
        place += length
        lo, hi = np.searchsorted(lonely, [at, at + len(starts)])
        if hi > lo:
            out.append((a, b, _to_runs(starts[lonely[lo:hi] - at])))
        at += len(starts)
    cols = list(zip(*out)) if out else [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()))],
                    names=["k1", "k2", "lonely"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        removed, digests, texts = [], [], []
        for text, runs, lonely in zip(*(c.to_pylist() for c in b.columns[2:])):
            w = words(text)
            starts = _from_runs(runs)
            if lonely is not None:
                starts = np.setdiff1d(starts, _from_runs(lonely), assume_unique=True)
            change = np.zeros(len(w) + 1, np.int64)
            change[starts] += 1
            change[starts + WINDOW] -= 1
            keep = np.cumsum(change)[:-1] == 0
            kept = [x for x, k in zip(w, keep.tolist()) if k]
            removed.append(len(w) - len(kept))
            digests.append(_digest(kept))
            texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
             pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)``, a row per row of
    ``docs``: the words left when every word is removed that a window covers
    whose word sequence also starts anywhere else, in any text.

    Windows are judged on the input.  ``kept`` holds the kept words joined by
    one space where words were removed, null elsewhere or without
    ``with_text``.  A null or empty text has no words; repeated rows are
    repeats of each other, each with its row, and so are rows with a null
    doc_id; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text").withColumns({
        "k1": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)),
        "k2": F.xxhash64(F.col("doc_id").isNull(), "text")})
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, int(size / BYTES_PER_WORD * COVER.mean() / PART))
    sent = rows.select("k1", "k2", "text").mapInArrow(_anchors(parts), _SENT)
    runs = (_exchange(sent, False).groupBy("batch").applyInArrow(_candidates, "k1 long, k2 long, runs binary")
            .dropDuplicates(["k1", "k2"]))
    judged = materialize(
        rows.join(runs, ["k1", "k2"], "left").select("doc_id", "k1", "k2", "text", "runs").mapInArrow(
            _judge, "doc_id long, k1 long, k2 long, text string, runs binary, n_words long, kept_sha256 string"),
        "judged")
    open_ = judged.where("runs is not null")
    sent = open_.select("k1", "k2", "text", "runs").mapInArrow(_windows(parts), _SENT)
    lonely = (_exchange(sent, True).groupBy("batch").applyInArrow(_refuted, "k1 long, k2 long, lonely binary")
              .dropDuplicates(["k1", "k2"]))
    done = judged.where("runs is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
        F.lit(None).cast("string").alias("kept"))
    cut = (open_.join(lonely, ["k1", "k2"], "left").select("doc_id", "n_words", "text", "runs", "lonely")
           .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"))
    out = done.unionAll(cut)
    return out.withColumn("kept", F.when(F.col("n_removed") > 0, F.col("kept"))) if with_text else out.drop("kept")
