"""Exact top-k search with MaxScore over sharded postings.

A vector is a document whose terms are its dimensions; the posting list of a
dimension holds each vector's integer there, and a query scores a document by
the sum of products.  Within a shard a query's dimensions are ordered by score
bound, the most that any posting of the list can add beyond the least.  The
dimensions whose bounds together can't lift a document over the query's k-th
best score are non-essential: only the others are traversed for all documents,
and a document is probed further, list by list, while its partial score plus
the bounds of the lists left can still compete.  Ties may compete, since they
are broken by id.

Queries go to every shard in blocks, each shard returns its k best per query,
and the shards' lists are merged.  Blocks bound the memory of a task whatever
the number of queries or vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofreq.llm.common import small_batches
from cofreq.session import materialize

K = 20
#: Vectors of a shard, queries of a block.
SHARD, QUERIES = 16384, 2048
#: Documents scored in full first, for a first threshold; documents at a time.
SEED, CHUNK = 512, 2048


def quantized(embedding: Column, scale: float = 64.0) -> Column:
    """Integers ``floor(scale * x)`` of the components, x as double; null if
    the vector is null or holds a null or non-finite component."""
    e = embedding.cast("array<double>")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(sound, F.lit(False)),
                  F.transform(e, lambda x: F.floor(x * scale).cast("long")))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Shard:
    """Posting lists of a shard: one per dimension, by ascending id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, docs = ids[order], vectors[order]
        self.rows = self.ids if rows is None else rows[order]
        self.docs = docs
        # exact in 64-bit floats: see _exact()
        self.lists = np.ascontiguousarray(docs.T.astype(np.float64))
        self.low, self.high = self.lists.min(axis=1), self.lists.max(axis=1)

    def top(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) for a query; row ``own`` takes no part."""
        q = query.astype(np.float64)
        n = len(self.ids)
        # each list adds between its least and least + bound
        ends = np.stack([q * self.low, q * self.high])
        least = ends.min(axis=0)
        bound = ends.max(axis=0) - least
        order = np.argsort(bound, kind="stable")
        upto = np.cumsum(bound[order])
        base = least.sum()
        seed = np.arange(min(n, SEED))
        score = q @ self.lists[:, seed]
        keep = self.rows[seed] != own if own is not None else np.ones(len(seed), bool)
        ids, scores = _best(self.ids[seed][keep], score[keep], k)
        for start in range(len(seed), n, CHUNK):
            stop = min(start + CHUNK, n)
            floor = scores[-1] if len(scores) == k else -np.inf
            # the longest prefix of small bounds that can't reach the floor
            split = int(np.searchsorted(upto + base, floor, "left"))
            essential, rest = order[split:], order[:split][::-1]
            partial = q[essential] @ self.lists[essential, start:stop] if len(essential) else np.zeros(stop - start)
            at = np.arange(start, stop)
            # what the lists left add at most: their least and their bounds
            room = least[rest].sum() + bound[rest].sum()
            alive = partial + room >= floor
            at, partial = at[alive], partial[alive]
            for step in range(0, len(rest), 8):
                if not len(at):
                    break
                some = rest[step:step + 8]
                partial = partial + q[some] @ self.lists[np.ix_(some, at)]
                room -= least[some].sum() + bound[some].sum()
                alive = partial + room >= floor
                at, partial = at[alive], partial[alive]
            if own is not None:
                other = self.rows[at] != own
                at, partial = at[other], partial[other]
            if len(at):
                ids, scores = _best(np.concatenate([ids, self.ids[at]]), np.concatenate([scores, partial]), k)
        return ids, scores


def _exact(docs: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all partial sums of products are exact in 64-bit floats."""
    if not docs.size or not queries.size:
        return True
    most = float(np.abs(docs).max()) * float(np.abs(queries).max()) * docs.shape[1]
    return most < 2.0 ** 52


def _plain(rows, ids, docs, query, own, k):
    """All scores in Python integers, for values too large for floats."""
    scores = [(-sum(int(a) * int(b) for a, b in zip(d, query)), int(i)) for r, i, d in zip(rows, ids, docs) if r != own]
    best = sorted(scores)[:k]
    return [i for _, i in best], [-s for s, _ in best]


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        ids, rows = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
        v = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<i8").reshape(-1, dim) if dim else np.zeros(
            (len(ids), 0), np.int64)
        out: list[list] = [[], [], [], []]
        docs, queries = v[~query], v[query]
        if len(docs):
            floats = _exact(docs, queries)
            shard = Shard(ids[~query], docs, rows[~query]) if floats else None
            for own, name, q in zip(rows[query].tolist(), ids[query].tolist(), queries):
                found, scores = shard.top(q, own, k) if floats else _plain(rows[~query], ids[~query], docs, q, own, k)
                out[0] += [own] * len(found)
                out[1] += [name] * len(found)
                out[2] += [int(x) for x in found]
                out[3] += [max(-2**63, min(2**63 - 1, int(x))) for x in scores]
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["row", "query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the k rows of
    ``vectors`` of the highest inner product, ties to the smaller vec_id, its
    own row left out; all rows if there are fewer.

    Both inputs hold ``row``, a number of its own for every row of either (a
    query that is a row of ``vectors`` has that row's), ``vec_id`` and
    ``vector``, an array of integers.  Rows with a null id or vector (or null
    components) take no part; every other row is a candidate and a query by
    itself, so ranks of a repeated query id start anew for each of its rows;
    vectors are compared with those of the same length only.  A score beyond 64 bits counts as the nearest 64-bit integer.  Empty
    tables give an empty result; other columns are ignored.
    """
    small_batches(vectors.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        sound = F.col("vec_id").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
        return df.where(sound).select(F.col("row").cast("long"), F.col("vec_id").cast("long"), F.col("vector").cast("array<long>"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.array(x, "<i8") for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in rows], pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary())],
                names=["row", "vec_id", "dim", "vector"])

    def packed(df: DataFrame, tag: str) -> DataFrame:
        return materialize(clean(df).mapInArrow(pack, "row long, vec_id long, dim int, vector binary"), tag)

    docs, asked = packed(vectors, "vectors"), packed(queries, "queries")
    shards, blocks = max(1, -(-docs.count() // shard)), max(1, -(-asked.count() // block))

    def number(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = (docs.withColumn("query", F.lit(False)).withColumn("shard", number(shards)).withColumn("block", every(blocks))
             .unionByName(asked.withColumn("query", F.lit(True)).withColumn("block", number(blocks))
                          .withColumn("shard", every(shards))))
    found = dealt.groupBy("dim", "shard", "block").applyInArrow(_search(k), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def embedding_top_k(embeddings: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """:func:`top_k` of the quantized embeddings; queries are the rows whose
    vec_id is divisible by ``every``.  Null ids and unsound vectors take no part,
    repeated rows count as rows of their own, an empty table gives none."""
    # numbered by a written table, so that queries and candidates agree
    vectors = materialize(embeddings.select("vec_id", quantized(F.col("embedding")).alias("vector"),
                                            F.monotonically_increasing_id().alias("row")), "quantized")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)


#: Rows of :func:`embedding_top_k` in DuckDB, for vectors of one length.
ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id,
         list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.r <> d.r AND len(q.v) = len(d.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
