"""Ranked lexical search over hashed max-sketches.

The index is a table of blocks, each of a few hundred documents.  A block keeps
for every document its terms and their counts, and two small tables of
counters: each term of a document is hashed to one counter of either table, and
a counter holds the largest count folded into it.  A term's impact grows with
its count, so the impact of the lesser of a term's two counters is never below
the term's real impact in that document.

Queries are looked up a batch at a time: the counters of a batch's terms, times
the terms' weights, bound the score of every document of the block.  Documents
are then scored exactly by descending bound until the next bound is below the
k-th best score so far.  Tasks keep the k best of each query over all their
blocks; the lists are merged by rank.  One block in 64 is searched first, and
its k-th best scores are where all other tasks start from.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofreq.llm.common import pack, small_batches, unpack
from cofreq.session import broadcast_if_small, materialize, release, run_folder

K = 50
#: Bytes of query terms searched in one pass over the index.
BATCH_BYTES = 8 << 20
#: Most counters of a block's sketch tables; a document beyond it is a block of its own.
CELLS = 2 << 20
#: Least width of a sketch table, and its width as a multiple of the document's terms.
WIDTH, SPREAD = 256, 4
#: One block in this many is searched first.
SEED = 64
_FULL = np.iinfo(np.uint16).max

#: Letters and digits stay, A-Z become small, bytes of other alphabets stay.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters and digits and of all
    characters beyond ASCII, only A-Z lower-cased."""
    return text.translate(_KEEP).split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _cells(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(width - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


_BLOCK = ("seed boolean, doc_ids array<bigint>, lengths array<bigint>, width int, sketch binary, "
          "vocab array<binary>, dfs array<bigint>, sizes binary, ids binary, counts binary")


def _block(docs: list[tuple], width: int) -> tuple:
    """One row of the index from ``(doc_id, length, Counter)`` documents."""
    vocab = sorted(set().union(*(c for _, _, c in docs)))
    number = {w: i for i, w in enumerate(vocab)}
    ids, counts, sizes = [], [], []
    for _, _, c in docs:
        pairs = sorted((number[w], n) for w, n in c.items())
        ids.extend(p[0] for p in pairs)
        counts.extend(p[1] for p in pairs)
        sizes.append(len(pairs))
    at = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
    ids, counts = np.array(ids, np.int32), np.array(counts, np.int64)
    sketch = np.zeros((2, width, len(docs)), np.uint16)
    for table, cell in zip(sketch, _cells(_hashes(vocab), width)):
        np.maximum.at(table, (cell[ids], at), np.minimum(counts, _FULL).astype(np.uint16))
    first = xxhash.xxh3_64_intdigest(repr(docs[0][:2]).encode() + vocab[0])
    # a row is read whole: most counters are 0, so packed they take little
    packed = zstandard.ZstdCompressor(level=1).compress(sketch.tobytes())
    return (first % SEED == 0, [d[0] for d in docs], [d[1] for d in docs], width, packed, vocab,
            np.bincount(ids, minlength=len(vocab)).tolist(), pack(np.array(sizes)), pack(ids), pack(counts))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        classes: dict[int, list] = {}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = terms(text or b"")
            if words:
                counted = Counter(words)
                width = max(WIDTH, 1 << (SPREAD * len(counted) - 1).bit_length())
                classes.setdefault(width, []).append((doc_id, len(words), counted))
        for width, docs in sorted(classes.items()):
            step = max(1, CELLS // (2 * width))
            for i in range(0, len(docs), step):
                row = _block(docs[i:i + step], width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (
                        pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(),
                        pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()))],
                    names=[c.split()[0] for c in _BLOCK.split(", ")])


def build_index(docs: DataFrame) -> DataFrame:
    """Writes the index of ``docs`` (``doc_id``, ``text``) and reads it back:
    one row per block of documents of one sketch width.

    Every row with at least one term is indexed, repeated or null ids included;
    rows without a term (null and empty texts) can match nothing.  A sketch
    table has at least four counters per term of a document, so long texts get
    wide tables and, in the extreme, a block of their own.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = f"{run_folder(spark)}/lexical-{uuid.uuid4().hex}"
    (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
     .mapInArrow(_blocks, _BLOCK).write.partitionBy("seed")
     .option("parquet.block.size", str(32 << 20)).parquet(path))
    out = spark.read.schema(_BLOCK).parquet(path)
    out._cofreq_path = path
    return out


class _Best:
    """The k best documents of a query: higher score, then smaller id, null first."""

    __slots__ = ("k", "scores", "nulls", "ids", "floor")

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(floor, 1)
        self.scores = self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor
        if not keep.any():
            return
        s, n, i = (np.concatenate([a, b[keep]]) for a, b in
                   ((self.scores, scores), (self.nulls, nulls), (self.ids, ids)))
        order = np.lexsort((i, ~n, -s))[:self.k]
        self.scores, self.nulls, self.ids = s[order], n[order], i[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


class _Batch:
    """Queries of one pass: their distinct terms, and each query's terms and weights."""

    def __init__(self, rows: list[tuple], n_docs: int, n_terms: int, k: int):
        self.words = sorted({t for _, ts, _, _ in rows for t in ts})
        number = {w: i for i, w in enumerate(self.words)}
        self.number, self.hashes = number, _hashes(self.words)
        self.queries = [(no, np.array([number[t] for t in ts], np.int64), np.array(ws, np.int64)) for no, ts, ws, _ in rows]
        self.best = [_Best(k, floor) for _, _, _, floor in rows]
        self.n_docs, self.n_terms = n_docs, n_terms

    def visit(self, row: dict) -> None:
        vocab, width = row["vocab"], row["width"]
        null = np.array([d is None for d in row["doc_ids"]], bool)
        ids = np.array([d or 0 for d in row["doc_ids"]], np.int64)
        n = len(ids)
        here = np.full(len(self.words), -1, np.int64)
        for i, w in enumerate(vocab):
            at = self.number.get(w)
            if at is not None:
                here[at] = i
        found = np.flatnonzero(here >= 0)
        if not len(found):
            return
        m = np.array([50 + (50 * x * self.n_docs) // self.n_terms for x in row["lengths"]], np.int64)
        sketch = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["sketch"]), np.uint16).reshape(2, width, n)
        a, b = _cells(self.hashes[found], width)
        count = np.minimum(sketch[0][a], sketch[1][b])
        most = count.astype(np.float64)
        most *= 1e6 / (most + 0.02 * m)
        most[count == _FULL] = 1e6
        place = np.full(len(self.words), -1, np.int64)
        place[found] = np.arange(len(found))
        counts = unpack(row["counts"])
        keys = np.repeat(np.arange(n), unpack(row["sizes"])) * len(vocab) + unpack(row["ids"])
        for (_, words, weights), best in zip(self.queries, self.best):
            known = here[words] >= 0
            if not known.any():
                continue
            mine, w = words[known], weights[known]
            # a margin for the rounding of floats; exact scores are integers
            bound = (w @ most[place[mine]]) * (1 + 1e-9)
            order = np.flatnonzero(bound >= best.floor)
            order = order[np.argsort(-bound[order], kind="stable")]
            step, start = 16, 0
            while start < len(order):
                some = order[start:start + step]
                some = some[bound[some] >= best.floor]
                if not len(some):
                    break
                want = some[:, None] * len(vocab) + here[mine]
                spot = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                tf = np.where(keys[spot] == want, counts[spot], 0)
                score = (w * ((1000000000 * tf) // (1000 * tf + 20 * m[some, None]))).sum(axis=1)
                best.add(score, null[some], ids[some])
                start, step = start + step, min(4 * step, 1024)

    def result(self) -> Iterator[pa.RecordBatch]:
        for (no, _, _), best in zip(self.queries, self.best):
            if len(best.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(best.ids), pa.int64()), pa.array(best.ids, mask=best.nulls),
                     pa.array(best.scores)], names=["query", "doc_id", "score"])


def _search(payload, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Batch(*payload.value, k)
        for batch in batches:
            for i in range(batch.num_rows):
                state.visit(batch.slice(i, 1).to_pylist()[0])
        yield from state.result()
    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t or b""))) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])


def search(index: DataFrame, items: DataFrame, k: int = K, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items``
    (``item_id``, ``text``) the k documents of ``index`` of the highest score
    above 0, equal scores by ascending doc_id (null first).

    With N documents that have terms, L terms in all and df documents holding a
    term, a term weighs ``floor(1000 * ln((2N+2) / (2df+1)))`` and adds ``weight
    * (10^9 * tf div (1000 * tf + 20 * m))``, where ``m = 50 + (50 * n * N) div
    L`` for a document of n terms.  Each document row is a document of its own
    and each item row a query of its own, whatever its id; items without terms,
    and empty tables, return nothing.  Queries go over the index in batches of
    about ``batch_bytes``, the only data sent to every task.
    """
    spark = index.sparkSession
    total = index.select(F.sum(F.size("lengths")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    schema = "item_id bigint, rank int, doc_id bigint, score bigint"
    if not n_docs:
        return spark.createDataFrame([], schema)
    asked = materialize(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
        .mapInArrow(_query_terms, "item_id bigint, terms array<binary>")
        .withColumn("query", F.monotonically_increasing_id()), "queries")
    pairs = asked.select("query", F.explode("terms").alias("term"))
    df = (index.select(F.explode(F.arrays_zip("vocab", "dfs")).alias("e")).select(F.col("e.vocab").alias("term"), F.col("e.dfs").alias("n"))
          .join(broadcast_if_small(pairs.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    weighed = materialize(
        pairs.join(df, "term").select("query", "term", weight.alias("w"))
        .groupBy("query").agg(F.collect_list(F.struct("term", "w")).alias("t"), F.sum(F.octet_length("term") + 24).alias("size")),
        "weights")
    size = weighed.agg(F.sum("size")).first()[0] or 0
    passes = -(-size // batch_bytes)
    found = []
    for p in range(passes):
        rows = [(r["query"], [bytes(t["term"]) for t in r["t"]], [t["w"] for t in r["t"]])
                for r in weighed.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == p).collect()]
        floors: dict[int, int] = {}
        for seed in (True, False):
            payload = spark.sparkContext.broadcast(([(*r, floors.get(r[0], 0)) for r in rows], n_docs, n_terms))
            hits = materialize(index.where(F.col("seed") == seed).mapInArrow(
                _search(payload, k), "query bigint, doc_id bigint, score bigint"), "hits")
            if seed:
                last = _ranked(hits, k).where(F.col("rank") == k)
                floors = {r["query"]: r["score"] for r in last.collect()}
            found.append(hits)
            payload.unpersist()
    if not found:
        return spark.createDataFrame([], schema)
    merged = found[0]
    for f in found[1:]:
        merged = merged.unionAll(f)
    top = materialize(_ranked(merged, k), "ranked")
    release(weighed, *found)
    return (top.join(broadcast_if_small(asked.select("query", "item_id")), "query")
            .select("item_id", "rank", "doc_id", "score"))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """:func:`search` of ``items`` in a new index of ``docs``."""
    index = build_index(docs)
    out = search(index, items, k)
    release(index)
    return out


#: Rows of :func:`ranked_search` in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (
  SELECT item_id, row_number() OVER () AS q,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
qt AS (SELECT item_id, q, unnest(t) AS term FROM q),
x AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM x GROUP BY ALL),
s AS (SELECT count(*) AS nd, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, s GROUP BY term, nd),
h AS (SELECT q, item_id, r, doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
      FROM qt JOIN w USING (term) JOIN tf USING (term), s GROUP BY q, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM h WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50
"""
