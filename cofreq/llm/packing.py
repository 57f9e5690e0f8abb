"""Mixture-controlled packing by deficit round-robin over source queues.

A window of fixed size is filled source by source.  Each source's deficit
grows by its quantum, its target share of a window, and it sends documents
while its deficit covers the next one; what is left is carried to the next
window.  A document is therefore sent in the first window whose quanta so far
cover all tokens of its queue up to its end:

    window = ceil(tokens up to and with the document / quantum)

which needs running sums only, so deficits carry across windows and Spark
partitions without a serial loop.  Targets may be given.  By default they are
the sources' shares of all tokens, so all queues end together and every window
holds the same mixture.  A queue that ends leaves later windows to the others,
in their targets' proportions to each other; these windows are shorter, and no
document is dropped or repeated.  The windows, one after the other, are one
stream that is cut into sequences: nothing is padded but the last one.

Running sums come from totals of hash buckets (in a queue) and of windows (in
the stream), themselves added up along a range sort; a window function only
runs inside a bucket, a window of the mixture or a range.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType)

from cofreq.llm.common import running, small_batches
from cofreq.llm.tokens import encoder, tokenizer_path
from cofreq.session import materialize

SEQUENCE = 1024
#: Tokens that a window of the mixture aims at.
WINDOW = 1 << 16
#: Buckets of a queue: at least, and rows that one of all queues aims at.
MIN_BUCKETS, BUCKET_ROWS = 64, 10_000
TOKENIZER, END_ID = "byte_bpe_50k.json", 0


def tokenized(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, source, n, width, ids)``: the ids of each whole text and the
    end id, packed little-endian with ``width`` bytes each."""
    path = path or tokenizer_path(TOKENIZER)
    small_batches(docs.sparkSession)
    schema = StructType([StructField("doc_id", LongType()), StructField("source", StringType()),
                         StructField("n", LongType()), StructField("width", IntegerType()),
                         StructField("ids", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        width = own.dtype.itemsize
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                ids = own.encode_many(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(x) // width for x in ids], pa.int64()),
                    pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "source", "n", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").mapInArrow(run, schema)


def shares(sizes: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """``(source, source_n, share)`` from ``(source, source_n)``: each source's
    part of a window.

    ``targets``: ``(source, weight)``, weights above 0, one row a source.  The
    sources named there divide by weight what they hold together of all
    tokens; a source that is not named keeps its own share, as all do without
    ``targets``.  Names of no source are ignored.
    """
    total = sizes.agg(F.sum("source_n")).first()[0] or 0
    own = F.col("source_n") / F.lit(float(max(total, 1)))
    if targets is None:
        return sizes.select("source", "source_n", own.alias("share"))
    wanted = targets.select(F.col("source").cast("string").alias("t_source"), F.col("weight").cast("double"))
    if wanted.where("weight is null or isnan(weight) or weight <= 0").limit(1).count():
        raise ValueError("target weights must be above 0")
    if wanted.groupBy("t_source").count().where("count > 1").limit(1).count():
        raise ValueError("a source has more than one target")
    both = materialize(sizes.join(wanted, F.col("source").eqNullSafe(F.col("t_source")), "left"), "shares")
    named, weights = both.where("weight is not null").agg(F.sum("source_n"), F.sum("weight")).first()
    part = F.col("weight") * F.lit(float(named or 0) / max(total, 1) / (weights or 1.0))
    return both.select("source", "source_n", F.coalesce(part, own).alias("share"))


def layout(rows: DataFrame, window: int = WINDOW, targets: DataFrame | None = None) -> DataFrame:
    """Place of each row of ``rows`` (a unique ``rid``, ``source``, ``n``) in
    the stream: ``(rid, place)``.

    A queue is shuffled by the hash of rid.  The quantum of a source is its
    share (see :func:`shares`) times ``window``.
    """
    n_buckets = max(MIN_BUCKETS, rows.count() // BUCKET_ROWS)
    rows = rows.withColumn("h", F.xxhash64("rid")).withColumn("bucket", F.pmod("h", F.lit(n_buckets)))
    buckets = materialize(rows.groupBy("source", "bucket").agg(F.sum("n").alias("bucket_n")), "buckets")
    order = F.col("source").asc_nulls_last()
    sources = shares(buckets.groupBy("source").agg(F.sum("bucket_n").alias("source_n")), targets)
    sources = running(sources, [order], source_start=F.col("source_n")).select(
        F.col("source").alias("q_source"), "source_start", "share")
    starts = (running(buckets, [order, "bucket"], start=F.col("bucket_n"))
              .join(sources, F.col("source").eqNullSafe(F.col("q_source")))
              .select(F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"),
                      (F.col("start") - F.col("source_start")).alias("before"), "share"))
    inside = (Window.partitionBy("source", "bucket").orderBy("h", "rid")
              .rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("before") + F.sum("n").over(inside)
    sent = materialize(
        rows.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
        .withColumn("upto", upto).withColumn("window", F.ceil(F.col("upto") / (F.col("share") * window)))
        .select("rid", "source", "n", "upto", "window"), "queue")
    windows = running(sent.groupBy("window").agg(F.sum("n").alias("window_n")), ["window"],
                      start=F.col("window_n")).select("window", "start")
    in_window = (Window.partitionBy("window").orderBy(F.col("source").asc_nulls_last(), "upto", "rid")
                 .rowsBetween(Window.unboundedPreceding, 0))
    return sent.join(windows, "window").select(
        "rid", (F.col("start") + F.sum("n").over(in_window) - F.col("n")).alias("place"))


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
         window: int = WINDOW, with_ids: bool = True, targets: DataFrame | None = None) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source, ids)`` of all documents in sequences of ``sequence`` ids.

    A null or empty text is its end id alone; a null source is a queue of its
    own; each repeated row is packed by itself; an empty table gives an empty
    result; other columns are ignored.  ``ids`` holds the piece's ids, packed
    little-endian with 32 bits each (null without ``with_ids``).  Every sequence but the last is full.
    """
    tokens = materialize(tokenized(docs, path, end_id).select(
        F.monotonically_increasing_id().alias("rid"), "*"), "tokens")
    places = layout(tokens.select("rid", "source", "n"), window, targets)
    small_batches(docs.sparkSession)
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, source string, ids binary")
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in names]
            for doc_id, source, width, packed, place in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(packed, f"<u{width}").astype("<u4")
                first = 0
                while first < len(ids):
                    at = place + first
                    length = min(sequence - at % sequence, len(ids) - first)
                    piece = ids[first:first + length].tobytes()
                    for c, x in zip(cols, (doc_id, first, length, crc32(piece), len(ids), at // sequence,
                                           at % sequence, source, piece if with_ids else None)):
                        c.append(x)
                    first += length
            types = [pa.int64()] * 7 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    # places grow with the documents: always by sorted shuffle, never broadcast
    return (tokens.join(places.hint("merge"), "rid").select("doc_id", "source", "width", "ids", "place")
            .mapInArrow(cut, schema))


def packed_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """:func:`pack` without source and ids."""
    return pack(docs, path, with_ids=False).drop("source", "ids")
