"""Language-model scoring with sharded Elias-Fano n-gram tries.

The model is an interpolated trigram model with absolute discounting (the
discount of an order is ``n1 / (n1 + 2 n2)`` of all training counts) over the
add-half unigram distribution.  Words are numbered by descending count.

A shard holds all n-grams of the middle words that hash to it, as a trie whose
levels are Elias-Fano sequences: middle words, their successors, the words
before them, and for each of these contexts the words that follow.  A following
word is stored by its place among the middle word's successors, a small number
whatever the vocabulary.  Pointers of a level are monotone, and each range of
siblings continues where the range before it ended, so a level is one monotone
sequence and a child is found by a successor search in its range.  Discounted
probabilities and interpolation weights are 16-bit codes of their logarithms.

Texts are cut into batches of about ``BATCH`` tokens; equal texts of a batch
are kept once.  Arrow finds and numbers the words of a batch; its distinct
words and their counts go to hash buckets, which add them up, number them and
answer.  Then each batch sends every shard its n-grams, a shard sorts them,
builds its trie from those of training texts and answers each distinct one
once, in order, so that searches stay near each other.  Only sums per text come
back, whole numbers of 1e-6, so reruns agree.

A word so frequent that its n-grams would overfill a task is dealt to several
shards by the hash of the words around it.  What such a shard lacks, how often
its pairs occur anywhere and with how many thirds, is added up in buckets and
handed back, like the counts that discounts need, before any trie is built.  So
the model is that of the whole corpus, and how its n-grams are dealt changes no
score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofreq.llm.common import pack, small_batches, unpack
from cofreq.llm.eliasfano import EliasFano, encode, image, mapped, views
from cofreq.session import materialize

#: Tokens of a batch; n-grams of a shard; text bytes for each bucket of words,
#: and of texts that are cut into words at once.
BATCH, SHARD, BUCKET_BYTES, TEXT_BYTES = 1_000_000, 1_000_000, 16 << 20, 4 << 20
#: The token after the last word; no word holds a blank.
END = b" "
#: Codes of a factor of two; the code of probability 0.
STEPS, NONE = 2048, 65535
#: Parts of a unit of log10 that scores are summed in.
UNIT = 1_000_000


def _code(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        code = np.rint(-np.log2(p) * STEPS)
    return np.where(p > 0, np.clip(code, 0, NONE - 1), NONE).astype(np.uint16)


def _decode(code: np.ndarray) -> np.ndarray:
    return np.where(code == NONE, 0.0, np.exp2(code.astype(np.float64) / -STEPS))


def _rare(counts: np.ndarray) -> tuple[int, int]:
    return int((counts == 1).sum()), int((counts == 2).sum())


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _starts(run: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))


def _ranks(values: np.ndarray) -> np.ndarray:
    """The places of sorted values among the distinct ones."""
    return np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and which of them each key is; sorted keys are not sorted again."""
    if len(keys) and (keys[1:] >= keys[:-1]).all():
        return keys[_starts(keys)], _ranks(keys)
    return np.unique(keys, return_inverse=True)


def _ranges(owner: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(owner, np.arange(n + 1)).astype(np.int64)


def _chained(children: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Children of all ranges as one increasing sequence: a range starts one
    past the last value of the range before it."""
    last = np.zeros(len(at) - 1, np.int64)
    some = np.diff(at) > 0
    last[some] = children[at[1:][some] - 1] + 1
    return children + np.repeat(np.cumsum(last) - last, np.diff(at))


def build_trie(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, times: np.ndarray,
               rare: tuple[int, int, int, int] | None = None, whole: tuple | None = None) -> bytes:
    """The image of a trie of the trigrams ``w1 w2 w3``, seen ``times`` each.

    ``rare``: how many pairs, then trigrams, the whole corpus has once and
    twice; by default as in these trigrams.  ``whole``: for trigrams of one
    middle word that are not all of its own, the word, its count, how many
    words follow it, the followers and their counts, and the words before it,
    their counts and how many thirds each of these contexts has."""
    if whole is None:
        words, i2 = _distinct(w2)
        size = int(max(w1.max(initial=0), w3.max(initial=0))) + 1
        keys, bi = _distinct(i2 * size + w3)
        owner, follows = np.divmod(keys, size)
        bi_at = _ranges(owner, len(words))
        bi_count = np.bincount(bi, times, len(keys))
        of_word = np.bincount(i2, times, len(words))
        n_follows = np.diff(bi_at)
        place = bi - bi_at[i2]
        keys, ctx = _distinct(i2 * size + w1)
        owner2, before = np.divmod(keys, size)
        ctx_at = _ranges(owner2, len(words))
        of_ctx = np.bincount(ctx, times, len(keys))
    else:
        word, of_word, n_follows, follows, bi_count, before, of_ctx, n_thirds = whole
        words, owner = np.array([word], np.int64), np.zeros(len(follows), np.int64)
        bi_at, ctx_at = np.array([0, len(follows)]), np.array([0, len(before)])
        place, ctx = np.searchsorted(follows, w3), np.searchsorted(before, w1)
    n_ctx, width = len(before), int(place.max(initial=0)) + 1
    keys, tri = _distinct(ctx * width + place)
    owner3, third = np.divmod(keys, width)
    tri_at = _ranges(owner3, n_ctx)
    tri_count = np.bincount(tri, times, len(keys))
    if whole is None:
        n_thirds = np.diff(tri_at)
    rare = rare or (*_rare(bi_count), *_rare(tri_count))
    d2, d3 = _discount(*rare[:2]), _discount(*rare[2:])
    levels = {"words": words, "bi_at": bi_at, "bi": _chained(follows, bi_at), "ctx_at": ctx_at,
              "ctx": _chained(before, ctx_at), "tri_at": tri_at, "tri": _chained(third, tri_at)}
    arrays = {f"{name}.{part}": a for name, level in levels.items() for part, a in encode(level).items()}
    arrays |= {"p2": _code((bi_count - d2) / (of_word[owner] if whole is None else of_word)), "b2": _code(np.atleast_1d(d2 * n_follows / of_word)),
               "p3": _code((tri_count - d3) / of_ctx[owner3]), "b3": _code(d3 * n_thirds / of_ctx)}
    return image(arrays)


class Trie:
    """Reads an image of :func:`build_trie` in place."""

    def __init__(self, buffer):
        self._load(views(buffer))

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie whose levels stay in the file and are memory-mapped."""
        out = cls.__new__(cls)
        out._load(mapped(path))
        return out

    def _load(self, arrays: dict[str, np.ndarray]) -> None:
        self.codes = {n: arrays[n] for n in ("p2", "b2", "p3", "b3")}
        self.levels = {n: EliasFano({p: arrays[f"{n}.{p}"] for p in ("n", "low", "high", "dir")})
                       for n in ("words", "bi_at", "bi", "ctx_at", "ctx", "tri_at", "tri")}

    def _child(self, level: str, i: int, x: int) -> int | None:
        """Where ``x`` lies in the level among the children of ``i``."""
        at, values = self.levels[level + "_at"], self.levels[level]
        lo, hi = at.get(i), at.get(i + 1)
        x += values.get(lo - 1) + 1 if lo else 0
        found = values.successor(lo, hi, x)
        return found if found < hi and values.get(found) == x else None

    def probability(self, w1: int, w2: int, w3: int, p1: float) -> float:
        """One n-gram's probability; ``p1`` is the last word's own."""
        words = self.levels["words"]
        i = words.successor(0, words.n, w2)
        if i == words.n or words.get(i) != w2:
            return p1
        value = lambda name, at: float(_decode(self.codes[name][at:at + 1])[0])
        bi, ctx = self._child("bi", i, w3), self._child("ctx", i, w1)
        p = value("b2", i) * p1 + (value("p2", bi) if bi is not None else 0)
        if ctx is None:
            return p
        tri = self._child("tri", ctx, bi - self.levels["bi_at"].get(i)) if bi is not None else None
        return value("b3", ctx) * p + (value("p3", tri) if tri is not None else 0)

    def _children(self, level: str, i: np.ndarray, x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`_child` of many: places, which were found, and the ranges' starts."""
        at, values = self.levels[level + "_at"].values(), self.levels[level].values()
        if not len(values):
            return np.zeros(len(i), np.int64), np.zeros(len(i), bool), at[i]
        base = np.where(at[:-1] > 0, values[at[:-1] - 1] + 1, 0)
        target = base[i] + x
        found = np.minimum(np.searchsorted(values, target), len(values) - 1)
        return found, known & (values[found] == target) & (found < at[i + 1]) & (found >= at[i]), at[i]

    def _values(self, name: str, at: np.ndarray, some: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at))
        out[some] = _decode(self.codes[name][at[some]])
        return out

    def probabilities(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, p1: np.ndarray) -> np.ndarray:
        """:meth:`probability` of many n-grams; levels are read one at a time."""
        words = self.levels["words"].values()
        if not len(words):
            return p1.copy()
        i = np.minimum(np.searchsorted(words, w2), len(words) - 1)
        known = words[i] == w2
        bi, two, start = self._children("bi", i, w3, known)
        p = np.where(known, self._values("b2", i, known) * p1 + self._values("p2", bi, two), p1)
        ctx, has = self._children("ctx", i, w1, known)[:2]
        ctx = np.where(has, ctx, 0)
        tri, three, _ = self._children("tri", ctx, np.where(two, bi - start, 0), has & two)
        return np.where(has, self._values("b3", ctx, has) * p + self._values("p3", tri, three), p)


#: Rows of two kinds: a batch without a bucket, and its words of one bucket.
_BATCH = ("batch bigint, bucket int, doc_ids array<bigint>, held array<boolean>, texts array<int>, sizes array<int>, "
          "times array<int>, tokens binary, words binary, counts binary")


def _record(schema: str, values: tuple) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_(), "double": pa.float64()}
    names, arrays = [], []
    for field, value in zip(schema.split(", "), values):
        name, kind = field.split()
        t = pa.list_(kinds[kind[6:-1]]) if kind.startswith("array<") else kinds[kind]
        names.append(name)
        arrays.append(pa.array([value], t))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _cut(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, list[bytes]]]:
    """The words of some texts at a time, where each text's words end among
    them, and the texts; A-Z lower-cased."""
    # bytes as they come, valid or not
    texts = texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())
    part = np.cumsum(pc.binary_length(texts).to_numpy()) // TEXT_BYTES
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)), len(texts)]
    for lo, hi in zip(cuts, cuts[1:]):
        lower = pc.ascii_lower(texts.slice(lo, hi - lo))
        lists = pc.ascii_split_whitespace(lower)
        # white space at either end of a text leaves an empty word there
        found = pc.greater(pc.binary_length(lists.values), 0)
        ends = np.concatenate([[0], np.cumsum(found.to_numpy(zero_copy_only=False))])[lists.offsets.to_numpy()[1:]]
        binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        # many words of a batch may come to more than 2 GB
        yield lists.values.filter(found).cast(pa.large_string()), ends, lower.view(binary).to_pylist()


def _batches(limit: int, buckets: int):
    def close(docs, sizes, times, tokens):
        coded, sizes, times = pa.concat_arrays(tokens).dictionary_encode(), np.array(sizes), np.array(times)
        words = pa.concat_arrays([coded.dictionary.view(pa.large_binary()), pa.array([END], pa.large_binary())])
        last = np.zeros(sizes.sum(), bool)
        last[np.cumsum(sizes) - 1] = True
        tokens = np.full(len(last), len(words) - 1)
        tokens[~last] = coded.indices.to_numpy()
        counts = np.bincount(tokens, np.repeat(times, sizes), len(words)).astype(np.int64)
        # words are numbered by bucket, so answers of the buckets fit together
        old = pc.sort_indices(words).to_numpy()
        ordered = words.take(pa.array(old)).to_numpy(zero_copy_only=False).tolist()
        bucket = np.array([xxhash.xxh32_intdigest(w, 7) % buckets for w in ordered])
        by_bucket = np.argsort(bucket, kind="stable")
        old, bucket, ordered = old[by_bucket], bucket[by_bucket], [ordered[i] for i in by_bucket.tolist()]
        number = np.empty(len(words), np.int64)
        number[old] = np.arange(len(words))
        ids, held, texts = zip(*docs)
        batch = uuid.uuid4().int >> 65
        yield _record(_BATCH, (batch, None, ids, held, texts, sizes, times, pack(number[tokens]), None, None))
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(words)]
        for lo, hi in zip(cuts, cuts[1:]):
            raw = zstandard.ZstdCompressor(level=1).compress(b"\n".join(ordered[lo:hi]))
            yield _record(_BATCH, (batch, int(bucket[lo]), *[None] * 6, raw, pack(counts[old[lo:hi]])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, sizes, times, tokens, seen, held_tokens = [], [], [], [], {}, 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for found, ends, texts in _cut(batch.column(2)):
                start = 0
                for end, text in zip(ends.tolist(), texts):
                    doc_id, held = next(rows)
                    key = xxhash.xxh3_128_digest(text)
                    at = seen.get(key)
                    if at is None:
                        at = seen[key] = len(sizes)
                        tokens.append(found.slice(start, end - start))
                        sizes.append(end - start + 1)
                        times.append(0)
                        held_tokens += sizes[at]
                    start = end
                    times[at] += not held
                    docs.append((doc_id, held, at))
                    if held_tokens >= limit:
                        yield from close(docs, sizes, times, tokens)
                        docs, sizes, times, tokens, seen, held_tokens = [], [], [], [], {}, 0
        if docs:
            yield from close(docs, sizes, times, tokens)
    return run


def _totals(table: pa.Table) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """A bucket's distinct words, their training counts, and each row's words
    by their places among them."""
    lists = [pc.split_pattern(pa.array([zstandard.ZstdDecompressor().decompress(w.as_py())], pa.large_binary()), b"\n").values
             for w in table.column("words")]
    coded = pa.concat_arrays(lists).dictionary_encode()
    places = coded.indices.to_numpy()
    total = np.bincount(places, np.concatenate([unpack(n.as_py()) for n in table.column("counts")]), len(coded.dictionary))
    return coded.dictionary, total.astype(np.int64), np.split(places, np.cumsum([len(x) for x in lists])[:-1])


def _tally(table: pa.Table) -> pa.Table:
    """How many words of a bucket have each count, words of other texts left out."""
    total = _totals(table)[1]
    counts, words = np.unique(total[total > 0], return_counts=True)
    bucket = pa.array(np.full(len(counts), table.column("bucket")[0].as_py()), pa.int32())
    return pa.table([bucket, pa.array(counts), pa.array(words)], names=["bucket", "n", "words"])


def _number(shared):
    """Numbers of a bucket's words for every batch, 0 for words without a
    count: a word comes after all of higher counts, and after the words of its
    count in lower buckets."""
    def run(table: pa.Table, offsets: pa.Table) -> pa.Table:
        uni, _ = shared.value
        words, total, places = _totals(table)
        some = pc.sort_indices(words).to_numpy()
        some = some[total[some] > 0]
        some = some[np.argsort(total[some], kind="stable")]
        counts, n = np.unique(total[some], return_counts=True)
        by_count = np.argsort(offsets.column("n").to_numpy())
        first = uni.first(counts) + offsets.column("before").to_numpy()[by_count]
        number = np.zeros(len(words), np.int64)
        number[some] = np.arange(len(some)) + np.repeat(first - (np.cumsum(n) - n), n)
        ids = [pack(number[p]) for p in places]
        return pa.table([table.column("batch"), table.column("bucket"), pa.array(ids, pa.binary())], names=["batch", "bucket", "ids"])
    return run


class _Unigrams:
    """Counts by word number, from ``(count, words of that count)`` by
    descending count.  Numbers follow descending counts, so the first
    number of every count says all: at most sqrt(2N) of them."""

    def __init__(self, steps: list[tuple[int, int]]):
        self.counts = np.array([c for c, _ in steps], np.int64)
        sizes = np.array([n for _, n in steps], np.int64)
        self.firsts = 1 + np.cumsum(sizes) - sizes
        self.tokens, self.words = int((self.counts * sizes).sum()), int(sizes.sum())
        self.start = self.words + 1

    def first(self, count: np.ndarray) -> np.ndarray:
        return self.firsts[len(self.counts) - 1 - np.searchsorted(self.counts[::-1], count)]

    def count(self, ids: np.ndarray) -> np.ndarray:
        if not self.words:
            return np.zeros(len(ids), np.int64)
        found = self.counts[np.searchsorted(self.firsts, np.maximum(ids, 1), "right") - 1]
        return np.where(ids > 0, found, 0)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.words + 1))


def _mixed(a: np.ndarray) -> np.ndarray:
    # multiplicative hashing spreads neighbouring numbers
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


class _Shards:
    """The shard of an n-gram: by its middle word, and for hot words (the first
    numbers, with their counts) by the words around it too."""

    def __init__(self, tokens: int, hot: list[int], size: int):
        self.plain = max(1, -(-tokens // size))
        self.parts = np.array([-(-c // size) for c in hot], np.int64)
        self.first = self.plain + np.cumsum(self.parts) - self.parts
        self.total = self.plain + int(self.parts.sum())

    def of(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> np.ndarray:
        out = _mixed(w2) % self.plain
        hot = (w2 > 0) & (w2 <= len(self.parts))
        at = w2[hot] - 1
        out[hot] = self.first[at] + _mixed(_mixed(w1[hot]) + w3[hot]) % self.parts[at]
        return out


_SENT = ("shard bigint, batch bigint, text binary, w1 binary, w2 binary, w3 binary, times binary, doc_ids array<bigint>, "
         "held array<boolean>, texts array<int>, sizes array<int>, known array<int>, base array<double>, own array<bigint>")


def _send(shared):
    """Every batch's n-grams by shard, and one row with what needs no shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni, shards = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in ("batch", "doc_ids", "held", "texts", "tokens")}
                sizes, times = (np.array(batch.column(n)[r].values, np.int64) for n in ("sizes", "times"))
                answers = sorted(batch.column("known")[r].as_py(), key=lambda a: a["bucket"])
                local = np.concatenate([unpack(a["ids"]) for a in answers])
                tokens = unpack(row["tokens"])
                w3 = local[tokens]
                text = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(w3)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                counts = uni.count(local)
                p1 = np.log10(uni.probability(counts))[tokens]
                back = lambda n: np.where(place >= n, np.concatenate([np.zeros(n, np.int64), w3])[:len(w3)], uni.start)
                w2, w1 = back(1), back(2)
                # the first word, and words after unknown ones, have no context
                alone = (place == 0) | (w2 == 0)
                own = np.bincount(text[alone], np.rint(p1[alone] * UNIT), len(sizes)).astype(np.int64)
                yield _record(_SENT, (-1 - row["batch"], row["batch"], *[None] * 5, row["doc_ids"], row["held"],
                                      row["texts"], sizes, np.bincount(text, (counts > 0)[tokens], len(sizes)).astype(np.int64),
                                      np.bincount(text, p1, len(sizes)), own))
                at = np.flatnonzero(~alone)
                shard = shards.of(w1[at], w2[at], w3[at])
                # a stable sort takes less time on numbers of 16 bits
                order = np.argsort(shard.astype(np.min_scalar_type(shards.total)), kind="stable")
                at, shard = at[order], shard[order]
                packed = pack(times)
                cuts = np.flatnonzero(np.diff(shard)) + 1
                for part in np.split(np.arange(len(at)), cuts) if len(at) else []:
                    some = at[part]
                    yield _record(_SENT, (int(shard[part[0]]), row["batch"], pack(text[some]), pack(w1[some]), pack(w2[some]),
                                          pack(w3[some]), packed, *[None] * 7))
    return run


def _empty(schema: str) -> pa.Table:
    return pa.Table.from_batches([_record(schema, (None,) * (schema.count(",") + 1))]).slice(0, 0)


def _ngrams(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts of the n-grams of each row of a shard; all distinct n-grams in
    the order of middle, first and last word, and how often training texts hold
    them; and which of these every n-gram is."""
    parts = [[unpack(table.column(n)[i].as_py()) for n in ("text", "w1", "w2", "w3", "times")] for i in range(table.num_rows)]
    w1, w2, w3 = (np.concatenate([p[c] for p in parts]) for c in (1, 2, 3))
    size = int(max(w1.max(), w2.max(), w3.max())) + 1
    key = (w2 if size < 1 << 31 else np.unique(w2, return_inverse=True)[1]) * size + w1
    order = np.argsort(key)
    key = _ranks(key[order]) * size + w3[order]
    again = np.argsort(key)
    order, key = order[again], key[again]
    starts = _starts(key)
    which = np.empty(len(order), np.int64)
    which[order] = _ranks(key)
    times = np.add.reduceat(np.concatenate([p[4][p[0]] for p in parts])[order], starts)
    first = order[starts]
    return [p[0] for p in parts], w1[first], w2[first], w3[first], times, which


#: Counts by pair of a shard that holds some of a hot word's n-grams, a bucket
#: at a time; or, of ``word`` 0, what a shard adds to the counts of all.  Keys
#: are twice the following word, or twice the word before and 1.
_PAIRS = "shard bigint, word bigint, bucket bigint, keys binary, counts binary, thirds binary, sums array<bigint>"


def _pairs(shared):
    """What one shard knows of its pairs and rare n-grams."""
    def run(table: pa.Table) -> pa.Table:
        if table.column("text").null_count:
            return _empty(_PAIRS)
        _, shards = shared.value
        shard = table.column("shard")[0].as_py()
        _, w1, w2, w3, times, _ = _ngrams(table)
        train = times > 0
        rare = (0, 0)
        if shard < shards.plain:
            key = _ranks(w2) * (int(w3.max()) + 1) + w3
            order = np.argsort(key)
            rare = _rare(np.add.reduceat(times[order], _starts(key[order])))
        out = [_record(_PAIRS, (None, 0, shard % 64, None, None, None, [*rare, *_rare(times[train]), 0]))]
        if shard >= shards.plain:
            keys, at = np.unique(np.concatenate([w3 * 2, w1 * 2 + 1]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([times, times]), len(keys)).astype(np.int64)
            # every trigram lies in one shard, so its contexts' thirds add up
            thirds = np.bincount(at[len(w3):][train], None, len(keys))
            word = int(w2[0])
            bucket = _mixed(keys) % shards.parts[word - 1]
            order = np.argsort(bucket, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                out.append(_record(_PAIRS, (shard, word, int(bucket[some[0]]), pack(keys[some]), pack(counts[some]), pack(thirds[some]), None)))
        return pa.Table.from_batches(out)
    return run


def _added(table: pa.Table) -> pa.Table:
    """A bucket's counts of all shards for each that asked, and what they add
    to the counts of all: pairs and trigrams once and twice, followers."""
    word, bucket = (table.column(n)[0].as_py() for n in ("word", "bucket"))
    if not word:
        sums = np.sum(np.array(table.column("sums").to_pylist(), np.int64), axis=0)
        return pa.Table.from_batches([_record(_PAIRS, (None, 0, bucket, None, None, None, sums))])
    asked = [unpack(k.as_py()) for k in table.column("keys")]
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    counts, thirds = (np.bincount(at, np.concatenate([unpack(x.as_py()) for x in table.column(n)]), len(keys)).astype(np.int64)
                      for n in ("counts", "thirds"))
    follows = counts[keys % 2 == 0]
    out = [_record(_PAIRS, (None, word, bucket, None, None, None, [*_rare(follows), 0, 0, int((follows > 0).sum())]))]
    for shard, some in zip(table.column("shard").to_pylist(), asked):
        i = np.searchsorted(keys, some)
        out.append(_record(_PAIRS, (shard, word, bucket, pack(some), pack(counts[i]), pack(thirds[i]), None)))
    return pa.Table.from_batches(out)


_ANSWER = ("batch bigint, text binary, sums array<bigint>, doc_ids array<bigint>, held array<boolean>, texts array<int>, "
           "sizes array<int>, known array<int>, base array<double>, own array<bigint>")


def _answer(shared):
    """One shard: its trie from the training texts' n-grams and the counts of
    all, then sums per text."""
    def run(table: pa.Table, counted: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _ANSWER.split(", ")]
        if not table.num_rows:
            return _empty(_ANSWER)
        if table.column("text").null_count:
            return table.append_column("sums", pa.nulls(table.num_rows, pa.list_(pa.int64()))).select(names)
        uni, shards = shared.value
        parts, w1, w2, w3, times, which = _ngrams(table)
        train = times > 0
        rare = counted.filter(counted.column("rare").is_valid()).to_pylist()[0]
        whole = None
        if table.column("shard")[0].as_py() >= shards.plain:
            given = counted.filter(counted.column("keys").is_valid())
            keys, counts, thirds = (np.concatenate([unpack(x.as_py()) for x in given.column(n)]) for n in ("keys", "counts", "thirds"))
            order = np.argsort(keys)
            order = order[counts[order] > 0]
            keys, counts, thirds = keys[order], counts[order], thirds[order]
            after, word = keys % 2 == 0, int(w2[0])
            n_follows = rare["follows"][rare["words"].index(word)]
            whole = (word, int(uni.count(w2[:1])[0]), n_follows, keys[after] // 2, counts[after], keys[~after] // 2, counts[~after], thirds[~after])
        trie = Trie(build_trie(w1[train], w2[train], w3[train], times[train], rare["rare"], whole))
        fixed = np.rint(np.log10(trie.probabilities(w1, w2, w3, uni.probability(uni.count(w3)))) * UNIT)[which]
        out, at = [], 0
        for i, text in enumerate(parts):
            # a batch sends its texts in ascending order
            starts = _starts(text)
            sums = np.add.reduceat(fixed[at:at + len(text)], starts).astype(np.int64)
            at += len(text)
            out.append(_record(_ANSWER, (table.column("batch")[i].as_py(), pack(text[starts]), sums, *[None] * 7)))
        return pa.Table.from_batches(out)
    return run


def _scored(spark, sent: DataFrame, shared, shards: _Shards) -> DataFrame:
    """Sums per text from the n-grams by shard.  All of it is one query, so the
    n-grams are shuffled once and read twice."""
    parts = min(shards.total, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards.total // 8))
    sent = sent.repartition(parts, "shard")
    added = (sent.groupBy("shard").applyInArrow(_pairs(shared), _PAIRS)
             .groupBy("word", "bucket").applyInArrow(_added, _PAIRS))
    by_word = (added.where("sums IS NOT NULL").groupBy("word")
               .agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(5)]))
    # one row; at most N / shard words are hot
    of_all = by_word.agg(F.array(*[F.sum(f"s{i}") for i in range(4)]).alias("rare"),
                         F.collect_list(F.struct("word", "s4")).alias("hot"))
    every = (spark.range(shards.total).crossJoin(F.broadcast(of_all))
             .select(F.col("id").alias("shard"), "rare", F.col("hot.word").alias("words"), F.col("hot.s4").alias("follows")))
    counted = added.where("shard IS NOT NULL").select("shard", "keys", "counts", "thirds").unionByName(every, allowMissingColumns=True)
    return (sent.groupBy("shard").cogroup(counted.repartition(parts, "shard").groupBy("shard"))
            .applyInArrow(_answer(shared), _ANSWER))


_SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _gather(tokens: int):
    def run(table: pa.Table) -> pa.Table:
        docs = table.filter(table.column("doc_ids").is_valid()).to_pylist()[0]
        total = np.array(docs["own"], np.int64)
        for raw, sums in zip(table.column("text"), table.column("sums")):
            if raw.is_valid:
                total[unpack(raw.as_py())] += np.array(sums.values, np.int64)
        at = np.array(docs["texts"], np.int64)
        return pa.table([pa.array(docs["doc_ids"], pa.int64()), pa.array(docs["held"], pa.bool_()),
                         pa.array(np.array(docs["sizes"], np.int64)[at]), pa.array(np.array(docs["known"], np.int64)[at]),
                         pa.array(np.full(len(at), tokens)), pa.array(np.array(docs["base"])[at]), pa.array(total[at] / UNIT)],
                        names=[c.split()[0] for c in _SCORE.split(", ")])
    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text is 1 modulo 5; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def score_documents(docs: DataFrame, batch: int = BATCH, shard: int = SHARD) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)`` for every row of ``docs`` (``doc_id``, ``text``): the log10
    probabilities of the text under the add-half unigram and the trigram model,
    both learnt from the rows not held out.

    Tokens are the words, A-Z lower-cased, and an end.  Null texts are empty:
    one token, the end.  Rows of a null id are training rows.  Repeated rows
    count and return as often as they come; a single long text is one batch.
    An empty table returns nothing, and without training rows every token is
    unknown and both scores follow the formula with N = V = 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    buckets = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    written = materialize(
        docs.select(F.col("doc_id").cast("long"), held_out().alias("held"), text).mapInArrow(_batches(batch, buckets), _BATCH), "lm-batches")
    batches = written.where("bucket IS NULL").drop("bucket", "words", "counts")
    words = written.where("bucket IS NOT NULL").select("batch", "bucket", "words", "counts")
    tally = materialize(words.groupBy("bucket").applyInArrow(_tally, "bucket int, n bigint, words bigint"), "lm-counts")
    # at most sqrt(2N) counts differ, and at most N / shard words are hot
    steps = sorted(((r["n"], r["words"]) for r in tally.groupBy("n").agg(F.sum("words").alias("words")).collect()), reverse=True)
    hot = [n for n, several in steps if n > shard for _ in range(several)]
    tokens = batches.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    uni = _Unigrams(steps)
    shards = _Shards(tokens, hot, shard)
    shared = spark.sparkContext.broadcast((uni, shards))
    before = Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("bucket", "n", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    known = (words.groupBy("bucket").cogroup(offsets.groupBy("bucket"))
             .applyInArrow(_number(shared), "batch bigint, bucket int, ids binary")
             .groupBy("batch").agg(F.collect_list(F.struct("bucket", "ids")).alias("known")))
    sent = batches.join(known, "batch").mapInArrow(_send(shared), _SENT)
    return (_scored(spark, sent, shared, shards)
            .groupBy("batch").applyInArrow(_gather(uni.tokens), _SCORE))
