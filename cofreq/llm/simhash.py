"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

A document's 64-bit fingerprint sums its shingle hashes bit by bit.  Two
fingerprints within three bits have a fingerprint between them that is at most
two flips from one and one flip from the other, so both emit it as a variant.
The variants are shuffled, and equal ones meet.

Which variants are emitted
    Flipping one bit changes the parity of a fingerprint's weight, so a pair
    at an odd distance has one even and one odd end, and a pair at distance
    two has ends of one parity.  The bits are dealt into two halves.

    * odd fingerprints emit their 64 single flips (all even);
    * even ones emit themselves, their 64 single flips (odd), and the double
      flips whose two bits lie in one half (992, even).

    Distance 1: the odd end flips onto the even end.  Distance 2: both ends'
    single flips meet halfway.  Distance 3: two of the three differing bits
    lie in one half; the even end flips those two, the odd end the third, and
    they meet.  That is every pair of the full radius-two ball with about a
    quarter of its variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cofreq.llm.common import KEY, ROW, connected_components, small_batches, with_key, with_row
from cofreq.session import materialize

#: Fingerprints of one task's batch, and variants that a shuffle part aims at.
BATCH, PART = 512, 500_000
#: Variants per fingerprint on average.
EMITTED = 561


def fingerprint(text: str | None, ngram: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text (a plain reference for small inputs
    and the body of the column version)."""
    h = _shingle_hashes(text, ngram)
    return int(_majority(h, np.array([0, len(h)]))[0])


def _shingle_hashes(text: str | None, ngram: int) -> list[int]:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    if len(words) <= ngram:
        return [xxh64_intdigest(b" ".join(words), 42)]
    return [xxh64_intdigest(s, 42)
            for s in map(b" ".join, zip(*(words[i:] for i in range(ngram))))]


def _majority(hashes, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes: a bit is set if it is in
    over half of a group.  Long groups are summed in slices, so the unpacked
    bits stay small."""
    h = np.asarray(hashes, dtype=np.uint64)
    n = len(offsets) - 1
    counts = np.zeros((n, 64), dtype=np.int64)
    step = 1 << 16
    for lo in range(0, len(h), step):
        hi = min(lo + step, len(h))
        bits = np.unpackbits(h[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        first = int(np.searchsorted(offsets, lo, "right")) - 1
        last = int(np.searchsorted(offsets, hi, "left"))
        for g in range(first, last):
            a, b = max(int(offsets[g]), lo), min(int(offsets[g + 1]), hi)
            if b > a:
                counts[g] += bits[a - lo:b - lo].sum(axis=0, dtype=np.int64)
    size = np.diff(offsets)[:, None]
    return np.packbits(counts * 2 > size, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, ngram: int = 3, text: str = "text",
                     name: str = "fingerprint") -> DataFrame:
    """``docs`` with a BIGINT column holding the fingerprint's 64 bits.

    ASCII letters are lower-cased, words are runs without ASCII white space,
    shingles are ``ngram`` words joined by a space (fewer words: all of them),
    repeats count.  A null or empty text has fingerprint zero.  Existing
    columns are kept; one called ``name`` is replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(name) if name in docs.columns else docs
    out = StructType([*docs.schema.fields, StructField(name, LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            fps = np.empty(batch.num_rows, dtype=np.int64)
            for lo in range(0, batch.num_rows, 128):
                texts = batch.column(at).slice(lo, 128).to_pylist()
                hashes: list[int] = []
                offsets = [0]
                for t in texts:
                    hashes += _shingle_hashes(t, ngram)
                    offsets.append(len(hashes))
                fps[lo:lo + len(texts)] = _majority(hashes, np.array(offsets)).view(np.int64)
            target = target or pa.schema([*batch.schema, pa.field(name, pa.int64())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], schema=target)

    return docs.mapInArrow(run, out)


def _flips() -> tuple[np.ndarray, np.ndarray]:
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(32, 1)
    low = one[i] | one[j]
    return one, np.concatenate([low, low << np.uint64(32)])


def _weight(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All variants of the given fingerprints and, for each, the bits flipped."""
    one, two = _flips()
    odd = (_weight(fps) & 1).astype(bool)
    none = np.zeros(1, dtype=np.uint64)
    even_mask = np.concatenate([none, one, two])
    masks = [np.tile(one, int(odd.sum())), np.tile(even_mask, int((~odd).sum()))]
    keys = [(fps[odd][:, None] ^ one).ravel(), (fps[~odd][:, None] ^ even_mask).ravel()]
    return np.concatenate(keys), np.concatenate(masks)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack_mask(mask: np.ndarray) -> np.ndarray:
    """A flip mask of at most two bits as 16 bits: count, then bit numbers."""
    n = _weight(mask).astype(np.uint16)
    low = mask & (~mask + np.uint64(1))
    i = _weight(low - np.uint64(1)).astype(np.uint16) & 63
    high = mask ^ low
    j = _weight(high - np.uint64(1)).astype(np.uint16) & 63
    return (n << 12) | (i << 6) | j


def _unpack_mask(code: np.ndarray) -> np.ndarray:
    n = code >> 12
    one = np.uint64(1)
    i = one << ((code >> 6) & 63).astype(np.uint64)
    j = one << (code & 63).astype(np.uint64)
    return np.where(n == 0, np.uint64(0), np.where(n == 1, i, i | j))


def _emit(parts: int):
    """One row per part and batch: that part's variants and flips, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo in range(0, len(all_fps), BATCH):
                keys, masks = _variants(all_fps[lo:lo + BATCH])
                part = ((keys * _MIX) >> np.uint64(33)) % np.uint64(parts)
                order = np.argsort(part.astype(np.uint32), kind="stable")
                keys, codes, part = keys[order], _pack_mask(masks[order]), part[order]
                found, first = np.unique(part, return_index=True)
                ends = [*first[1:], len(keys)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.astype(np.int32)),
                    pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                    pa.array([codes[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                ], names=["part", "keys", "codes"])
    return run


def _meet(packed: pa.Table) -> pa.Table:
    """Links of one part's variants: a star over each set of fingerprints that
    share a variant, so links never outnumber variants.

    In a set around an even variant the centre itself and the odd members are
    within three bits of every member, so one of them is the star's middle;
    even members alone are at distance two or four, and the former meet again
    around an odd variant.  Around an odd variant all members are at distance
    two.  Every link is checked once more by counting bits.
    """
    key = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in packed.column("keys")])
    code = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in packed.column("codes")])
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    inside = np.zeros(len(key), dtype=bool)
    inside[1:] |= same
    inside[:-1] |= same
    key, code = key[inside], code[order][inside]
    flips = code >> 12
    fp = key ^ _unpack_mask(code)
    odd_key = (_weight(key) & 1).astype(bool)
    # the middle first: fewest flips, then the smallest fingerprint
    order = np.lexsort((fp, flips, key))
    key, fp, flips, odd_key = key[order], fp[order], flips[order], odd_key[order]
    start = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))
    use = ~start & (odd_key | (flips[head] < 2))
    a, b = fp[head[use]], fp[use]
    near = _weight(a ^ b) <= 3
    pairs = np.unique(np.stack([a[near], b[near]], axis=1), axis=0)
    return pa.table({"a": pairs[:, 0].copy().view(np.int64), "b": pairs[:, 1].copy().view(np.int64)})


def links(fps: DataFrame, n: int) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what distances up to three bits
    connect.  ``fps`` has one BIGINT column of ``n`` distinct fingerprints."""
    parts = max(1, -(-n * EMITTED // PART))
    packed = fps.mapInArrow(_emit(parts), "part int, keys binary, codes binary")
    return (packed.groupBy("part")
            .applyInArrow(_meet, "a bigint, b bigint").distinct())


def fingerprint_groups(fps: DataFrame) -> DataFrame:
    """``(fingerprint, root)`` for each distinct value of the BIGINT column
    ``fingerprint``; ``root`` is any one fingerprint, the same within a group.
    """
    distinct = materialize(fps.select("fingerprint").distinct(), "fingerprints")
    n = distinct.count()
    spread = distinct.repartition(max(1, -(-n // BATCH)), "fingerprint")
    found = connected_components(links(spread, n))
    return distinct.join(found, distinct.fingerprint == found.node, "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("root"))


def simhash_components(docs: DataFrame, ngram: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    doc_id reachable over links of three or fewer bits.  Rows with a null
    doc_id take part but never name a group (a group of such rows only has a
    null component_id); repeated rows each get their row; an empty table gives
    an empty result.  Other columns are ignored.
    """
    fp = materialize(with_fingerprint(docs.select("doc_id", "text"), ngram)
                     .select("doc_id", "fingerprint"), "simhash")
    groups = materialize(fingerprint_groups(fp), "groups")
    least = fp.groupBy("fingerprint").agg(F.min("doc_id").alias("low"))
    name = (least.join(groups, "fingerprint").groupBy("root")
            .agg(F.min("low").alias("component_id")))
    by_print = groups.join(name, "root").select("fingerprint", "component_id")
    return fp.join(by_print, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, ngram: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest
    doc_id (nulls last), then of the smallest hash of its text; of rows equal
    in both any one.  Columns, whatever their names, stay as they are; null
    and empty texts are one group; an empty table stays empty."""
    hashed = with_key(with_fingerprint(docs.select("doc_id", "text"), ngram, name="__fp"), "text")
    narrow = materialize(hashed.select(F.col("__fp").alias("fingerprint"),
                                       F.struct(*KEY).alias("__row")), "simhash")
    groups = fingerprint_groups(narrow)
    best = (narrow.groupBy("fingerprint").agg(F.min("__row").alias("__row"))
            .join(groups, "fingerprint").groupBy("root").agg(F.min("__row").alias("__row"))
            .select("__row.*").distinct())
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))
    return (with_row(docs, "text").join(best, list(KEY), "left_semi")
            .withColumn("__n", nth).where("__n = 1").select(f"{ROW}.*"))
