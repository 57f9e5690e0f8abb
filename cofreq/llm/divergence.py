"""Source divergence audit: which sources of a language use words differently.

Term counts come from single-pass in-memory indexing.  A task reads texts into
postings (term, document: language, source, count) until it holds ``MEMORY`` of
them, then adds them up and spills a run: for every slice of the hash space one
row with its terms in sorted order, their documents by language and their
counts by source.  The runs of a shard, one or more slices, are merged by a
heap, and the places that a term has in the runs add up to its frequencies.

Distances between sources are sums over all kept terms of the language.  A term
that neither source has adds the same to a pair every time, so a pair starts
at ``V`` times that and the merged postings are streamed as corrections: each
posting corrects the pairs of its source.  Sources are numbered and cut into
tiles, and a task holds the pairs of two tiles.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofreq.llm.common import pack, small_batches, unpack
from cofreq.operators.encode import dense_ids
from cofreq.session import materialize, release

MIN_DOCS, TOP = 10, 10
#: Postings of a run; postings of a merge shard; terms of a correction task; sources of a tile.
MEMORY, SHARD, PART, TILE = 1_500_000, 500_000, 100_000, 128
#: Text bytes for each slice of the hash space; a merge shard is one or more slices.
SLICE_BYTES = 8 << 20
SCALE = 1_000_000_000

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters and of all characters
    beyond ASCII, only A-Z lower-cased."""
    return text.translate(_KEEP).split()


_RUN = ("slice int, postings bigint, terms binary, langs array<binary>, sources array<binary>, "
        "term binary, of binary, count binary, df_term binary, df_lang array<binary>, df_of binary, df binary")
_RUN_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), *[pa.binary()] * 4,
              pa.list_(pa.binary()), pa.binary(), pa.binary()]


def _summed(key: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their weights."""
    keys, inverse = np.unique(key, return_inverse=True)
    return keys, np.bincount(inverse, weights, len(keys)).astype(np.int64)


class _Block:
    """Postings in memory: terms and (language, source) groups by number, and
    a document's terms, counts and group."""

    def __init__(self):
        self.words, self.groups = defaultdict(), defaultdict()
        # the next free number
        self.words.default_factory, self.groups.default_factory = self.words.__len__, self.groups.__len__
        self.ids, self.counts, self.docs, self.held = [], [], [], 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        counted = Counter(terms(text))
        self.ids.append(np.fromiter(map(self.words.__getitem__, counted), np.int64, len(counted)))
        self.counts.append(np.fromiter(counted.values(), np.int64, len(counted)))
        self.docs.append((self.groups[lang, source], len(counted)))
        self.held += len(counted)

    def spill(self, slices: int) -> Iterator[pa.RecordBatch]:
        """The block as a run: the terms by slice of the hash space, each in order."""
        if not self.held:
            return
        words, groups = list(self.words), list(self.groups)
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        words = [words[i] for i in order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        of, size = np.array(self.docs, np.int64).T
        term, of = rank[np.concatenate(self.ids)], np.repeat(of, size)
        langs = sorted({g[0] for g in groups})
        number = {g: i for i, g in enumerate(langs)}
        lang = np.array([number[g[0]] for g in groups], np.int64)
        key, times = _summed(term * len(groups) + of, np.concatenate(self.counts))
        p_term, p_of = np.divmod(key, len(groups))
        key, df = _summed(term * len(langs) + lang[of])
        d_term, d_lang = np.divmod(key, len(langs))
        part = np.array([xxhash.xxh32_intdigest(w, 7) % slices for w in words], np.int64)
        of_part = [part, part[p_term], part[d_term]]
        by = [np.argsort(p, kind="stable") for p in of_part]
        ends = [np.searchsorted(p[b], np.arange(slices + 1)) for p, b in zip(of_part, by)]
        local = np.empty(len(words), np.int64)
        local[by[0]] = np.arange(len(words)) - ends[0][part[by[0]]]
        for s in np.unique(part):
            mine, p, d = (b[e[s]:e[s + 1]] for b, e in zip(by, ends))
            used, of_used = np.unique(p_of[p], return_inverse=True)
            raw = zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[i] for i in mine))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((
                    int(s), len(p), raw, [groups[i][0] for i in used], [groups[i][1] for i in used], pack(local[p_term[p]]),
                    pack(of_used), pack(times[p]), pack(local[d_term[d]]), langs, pack(d_lang[d]), pack(df[d])), _RUN_TYPES)],
                names=[c.split()[0] for c in _RUN.split(", ")])


def _runs(memory: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for row in zip(*batch.columns):
                block.add(*(v.as_py() for v in row))
                if block.held >= memory:
                    yield from block.spill(slices)
                    block = _Block()
        yield from block.spill(slices)
    return run


_FREQ = "lang string, term string, sources array<string>, counts array<bigint>"


def _merge(min_docs: int):
    def run(table: pa.Table) -> pa.Table:
        rows = range(table.num_rows)
        lists = [zstandard.ZstdDecompressor().decompress(table.column("terms")[i].as_py()).split(b"\n") for i in rows]
        # the runs' terms in one order; a term's number goes to its place in every run that has it
        numbers = [np.empty(len(words), np.int64) for words in lists]
        merged: list[bytes] = []
        last = None
        for word, i, at in heapq.merge(*(zip(words, repeat(i), count()) for i, words in enumerate(lists))):
            if word != last:
                merged.append(word)
                last = word
            numbers[i][at] = len(merged) - 1
        groups, langs = defaultdict(), defaultdict()
        groups.default_factory, langs.default_factory = groups.__len__, langs.__len__
        parts: list[list] = [[], [], [], [], [], []]
        for i in rows:
            row = {n: table.column(n)[i].as_py() for n in table.column_names if n != "terms"}
            own = np.array([groups[g] for g in zip(row["langs"], row["sources"])], np.int64)
            lang = np.array([langs[g] for g in row["df_lang"]], np.int64)
            for held, a in zip(parts, (numbers[i][unpack(row["term"])], own[unpack(row["of"])], unpack(row["count"]),
                                       numbers[i][unpack(row["df_term"])], lang[unpack(row["df_of"])], unpack(row["df"]))):
                held.append(a)
        term, of, n, d_term, d_lang, df = (np.concatenate(p) for p in parts)
        keys, df = _summed(d_term * len(langs) + d_lang, df)
        names = list(groups)
        lang_of = np.array([langs[g[0]] for g in names], np.int64)
        keep = np.isin(term * len(langs) + lang_of[of], keys[df >= min_docs])
        # postings in the order of (term, language, source)
        order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        keys, n = _summed(term[keep] * len(names) + place[of[keep]], n[keep])
        term, of = np.divmod(keys, len(names))
        of = order[of]
        starts = np.flatnonzero(np.diff(term * len(langs) + lang_of[of], prepend=-1))
        offsets = pa.array(np.append(starts, len(of)).astype(np.int32))
        text = lambda a: pa.array(a, pa.binary()).cast(pa.string())
        return pa.table([text([names[i][0] for i in of[starts]]), text([merged[i] for i in term[starts]]),
                         pa.ListArray.from_arrays(offsets, text([names[i][1] for i in of])),
                         pa.ListArray.from_arrays(offsets, pa.array(n))], names=["lang", "term", "sources", "counts"])
    return run


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, memory: int = MEMORY, shard: int = SHARD) -> DataFrame:
    """``(lang, term, sources, counts)``: for every term in at least
    ``min_docs`` documents of a language, its occurrences in each source that
    has it.  ``docs`` holds lang, source and text; nulls count as ''.

    The runs are written, cut into slices of the hash space by the bytes of all
    texts, and merged in shards of slices that hold about ``shard`` postings.
    """
    small_batches(docs.sparkSession)
    clean = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")))
    slices = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE_BYTES
    runs = materialize(clean.mapInArrow(_runs(memory, slices), _RUN), "runs")
    shards = min(slices, max(1, -(-(runs.agg(F.sum("postings")).first()[0] or 0) // shard)))
    merged = runs.withColumn("shard", F.pmod("slice", F.lit(shards))).groupBy("shard").applyInArrow(_merge(min_docs), _FREQ)
    out = materialize(merged, "frequencies")
    release(runs)
    return out


def _ratio(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * count / total)``, exact for ``count <= total < 9e13``."""
    a, rest = np.divmod(count * 10_000, total)
    return 1 + a * 100_000 + (rest * 100_000) // total


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return (gap * gap) // (p + q)


_PAIR = "i bigint, j bigint, value bigint"


def _corrections(table: pa.Table) -> pa.Table:
    """Sums of a part of the terms over the pairs of two tiles: rows with
    ``tile`` hold a tile's numbers and totals, the others a term's postings."""
    rows = table.to_pylist()
    heads = [r for r in rows if r["totals"] is not None]
    kept = heads[0]["kept"]
    totals = {i: n for h in heads for i, n in zip(h["ids"], h["totals"])}
    ids = sorted(totals)
    place = {i: at for at, i in enumerate(ids)}
    total = np.array([totals[i] for i in ids], np.int64) + 2 * kept
    n = len(ids)
    zero = np.zeros(n, np.int64)
    if kept:
        none = _ratio(np.full(n, 2, np.int64), total)
        value = np.zeros((n, n), np.int64)
        base = _distance(none[:, None], none[None, :])
        if heads[0]["part"] == 0:
            value += kept * base
        at, of, count = [], [], []
        for t, r in enumerate(r for r in rows if r["totals"] is None):
            at.extend([t] * len(r["ids"]))
            of.extend(place[i] for i in r["ids"])
            count.extend(r["counts"])
        at, of, count = (np.array(x, np.int64) for x in (at, of, count))
        n_terms = int(at.max()) + 1 if len(at) else 0
        for start in range(0, n_terms, 4096):
            lo, hi = np.searchsorted(at, [start, start + 4096])
            t, s = at[lo:hi] - start, of[lo:hi]
            p = np.broadcast_to(none, (min(4096, n_terms - start), n)).copy()
            has = np.zeros(p.shape, bool)
            p[t, s] = _ratio(count[lo:hi] + 2, total[s])
            has[t, s] = True
            for i in range(n):
                mine = np.flatnonzero(has[:, i])
                if len(mine):
                    # a pair that both sources correct is counted by the first of them
                    once = ~has[mine] | (np.arange(n) > i)
                    change = ((_distance(p[mine, i][:, None], p[mine]) - base[i]) * once).sum(axis=0)
                    change[i] = 0
                    value[i] += change
                    value[:, i] += change
    else:
        value = np.zeros((n, n), np.int64)
    a, b = ({place[i] for i in h["ids"]} for h in (heads[0], heads[-1]))
    left, right = np.array(sorted(a)), np.array(sorted(b))
    i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    keep = i < j if len(heads) == 1 else np.ones(len(i), bool)
    i, j, number = i[keep], j[keep], np.array(ids, np.int64)
    return pa.table([pa.array(number[i]), pa.array(number[j]), pa.array(value[i, j])], names=["i", "j", "value"])


def _pair_values(groups: DataFrame, postings: DataFrame, tile: int, part: int) -> DataFrame:
    """``(i, j, value)`` for i < j of one language.  ``groups`` numbers the
    sources in language order, so a language's tiles follow each other."""
    numbered = groups.withColumn("tile", F.floor(F.col("id") / tile))
    tiles = numbered.groupBy("lang", "tile").agg(
        F.collect_list(F.struct("id", "total")).alias("held"), F.first("kept").alias("kept"))
    span = tiles.groupBy("lang").agg(F.min("tile").alias("lo"), F.max("tile").alias("hi"), F.first("kept").alias("kept"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("kept") / part))

    def met(df: DataFrame, own: str) -> DataFrame:
        """A row for every pair of tiles of the language that ``own`` is in."""
        other = F.explode(F.sequence("lo", "hi"))
        return (df.withColumn("_other", other).withColumn("a", F.least(own, "_other")).withColumn("b", F.greatest(own, "_other")))

    heads = (met(tiles.drop("kept").join(span, "lang"), "tile")
             .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("lang", "a", "b", "part", "kept", F.col("held.id").alias("ids"), F.col("held.total").alias("totals"),
                     F.lit(None).cast("array<bigint>").alias("counts")))
    rows = (met(postings.withColumn("tile", F.floor(F.col("id") / tile)).groupBy("lang", "term", "tile")
                .agg(F.collect_list(F.struct("id", "n")).alias("held")).join(span, "lang"), "tile")
            .groupBy("lang", "a", "b", "term", "kept").agg(F.flatten(F.collect_list("held")).alias("held"))
            .withColumn("part", F.pmod(F.xxhash64("term"), F.greatest(F.lit(1), F.ceil(F.col("kept") / part))))
            .select("lang", "a", "b", "part", "kept", F.col("held.id").alias("ids"),
                    F.lit(None).cast("array<bigint>").alias("totals"), F.col("held.n").alias("counts")))
    return (heads.unionByName(rows).groupBy("lang", "a", "b", "part").applyInArrow(_corrections, _PAIR)
            .groupBy("i", "j").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, memory: int = MEMORY, shard: int = SHARD,
          tile: int = TILE, part: int = PART) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (lang, source) of
    ``docs`` (lang, source, text; null counts as '').

    A language keeps the V terms in at least ``min_docs`` of its documents.  A
    group (a source, or the whole language) gives a kept term ``p = 1 +
    floor(10^9 * (count + 2) / (N + 2V))``, N its occurrences of kept terms; two
    groups differ by ``floor((p - q)^2 / (p + q))`` in a term.  Part ``pair``
    ranks every other source of the language by the sum over all kept terms;
    part ``term`` ranks the ``top`` terms that the source has, and has more
    often than the language.  Larger values first, equal ones by item in UTF-8
    order.  A source without terms is a group like any other, and a language
    without kept terms gives pairs of value 0.  Repeated rows are documents of
    their own; an empty table returns nothing.  The pairs of a language are
    part of the result: they grow with the square of its sources.
    """
    freq = frequencies(docs, min_docs, memory, shard)
    flat = freq.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"))
    whole = freq.withColumn("n", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x))
    langs = materialize(whole.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total")), "languages")
    present = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (present.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["total", "kept", "lang_total"]))
    groups = materialize(dense_ids(groups, [F.asc("lang"), F.asc("source")], "id", start=0), "groups")

    values = materialize(_pair_values(
        groups.select("lang", "id", "total", "kept"),
        flat.join(groups.select("lang", "source", "id"), ["lang", "source"]).select("lang", "term", "id", "n"), tile, part), "pairs")
    both = values.unionAll(values.select(F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    pairs = (both.join(groups.select(F.col("id").alias("i"), "lang", "source"), "i")
             .join(groups.select(F.col("id").alias("j"), F.col("source").alias("item")), "j")
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    def share(count: str, total: str):
        # decimal digits keep the product exact at any corpus size
        return F.expr(f"1 + (cast({count} + 2 as decimal(19,0)) * {SCALE}) div ({total} + 2 * kept)")

    known = flat.join(whole.select("lang", "term", F.col("n").alias("lang_n")), ["lang", "term"]).join(
        groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    over = (known.withColumn("p", share("n", "total")).withColumn("q", share("lang_n", "lang_total")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, over)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))


#: Rows of :func:`audit` in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
x AS (SELECT r, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM x JOIN k USING (lang, term) GROUP BY ALL),
lc AS (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
lt AS (SELECT lang, sum(n)::BIGINT AS total FROM lc GROUP BY lang),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n,
             (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gt.total + 2 * v.v))::BIGINT AS p
      FROM gt JOIN k ON gt.lang = k.lang JOIN v ON v.lang = gt.lang
      LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
lp AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 2)) // (lt.total + 2 * v.v))::BIGINT AS q
       FROM lc JOIN lt USING (lang) JOIN v USING (lang)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q)
  FROM p JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
