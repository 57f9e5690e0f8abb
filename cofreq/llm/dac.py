"""Token ids as directly addressable codes.

An id is split into chunks of eight bits.  Level 0 holds the lowest chunk of
every id and a bitmap that says which ids go on; level 1 holds the next chunk
of those only, and so on.  The place of an id on the next level is the number
of set bits before it, which a rank directory gives in constant time, so any
token can be read without decoding others.

A table of token files holds blocks: one row per block with its part (the
range of documents it belongs to), its order and first token there, and the
block itself as one binary value:

    magic "DAC1", then little-endian: n_docs u4, n_tokens u8, n_levels u1
    doc ids i8[n_docs], 1 if the id is null u1[n_docs], ends u8[n_docs]
    per level: length u8, chunks u1[length], and but for the last level
    bitmap u1[ceil(length / 8)] and ranks u8[ceil(length / 512)]

Spark's writer commits the table, so lost executors leave no partial file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cofreq.llm.common import small_batches
from cofreq.llm.tokens import encoder, tokenizer_path
from cofreq.session import run_folder

MAGIC = b"DAC1"
TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Tokens from which on a block is closed; a document stays in one block.
BLOCK = 1 << 18
#: Bits between two entries of a rank directory.
RANK = 512


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One block of documents' ids (unsigned, below 2^32)."""
    flat = np.concatenate(ids).astype(np.uint32) if ids else np.zeros(0, np.uint32)
    ends = np.cumsum([len(x) for x in ids], dtype="<u8") if ids else np.zeros(0, "<u8")
    levels = []
    rest = flat
    while True:
        more = rest > 255
        levels.append(((rest & 255).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [MAGIC, struct.pack("<IQB", len(doc_ids), len(flat), len(levels)),
           np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
           np.array([d is None for d in doc_ids], np.uint8).tobytes(), ends.tobytes()]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            ones = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), RANK))
            out += [np.packbits(more, bitorder="little").tobytes(),
                    np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u8").tobytes()]
    return b"".join(out)


class Block:
    """A block read from its bytes; nothing is decoded until asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        n_docs, self.n_tokens, n_levels = struct.unpack_from("<IQB", data, 4)
        at = 17

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.ends = take("<u8", n_docs).astype(np.int64)
        self.levels = []
        for k in range(n_levels):
            n = int(take("<u8", 1)[0])
            chunks = take("u1", n)
            last = k == n_levels - 1
            bitmap = None if last else take("u1", -(-n // 8))
            ranks = None if last else take("<u8", -(-n // RANK))
            self.levels.append((chunks, bitmap, ranks))

    def rank(self, level: int, i: int) -> int:
        """Ids of ``level`` before its ``i``-th that go on."""
        _, bitmap, ranks = self.levels[level]
        near = i // RANK * RANK
        last = int(bitmap[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return (int(ranks[i // RANK]) + int(np.bitwise_count(bitmap[near // 8:i // 8]).sum())
                + last.bit_count())

    def token(self, i: int) -> int:
        """The ``i``-th id, by one rank a level."""
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if bitmap is None or not int(bitmap[i // 8]) >> i % 8 & 1:
                return value
            i = self.rank(level, i)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: on each level they lie side by side."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        a, b = start, stop
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            if bitmap is None:
                break
            bits = np.unpackbits(bitmap[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            where = where[bits]
            a = self.rank(level, a)
            b = a + len(where)
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 block: int = BLOCK) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the
    ids at ``path`` in ascending doc_id order (null first; repeated ids in the
    order read).  Documents are range-partitioned by id, so a part is a range
    and its blocks follow each other; repeated ids are told apart by their
    place in the input, so one id's rows may span parts.  Other columns are
    ignored."""
    tokenizer = tokenizer or tokenizer_path(TOKENIZER)
    small_batches(docs.sparkSession)
    dealt = (docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("nth"))
             .repartitionByRange("doc_id", "nth").sortWithinPartitions("doc_id", "nth").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(tokenizer, end_id)
        part, nth, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([write_block(doc_ids, ids)], pa.binary())],
                names=["part", "nth", "first", "n_tokens", "block"])

        for b in batches:
            for lo in range(0, b.num_rows, 64):
                some = b.slice(lo, 64)
                for d, x in zip(some.column(0).to_pylist(), own.encode_many(some.column(1).to_pylist())):
                    doc_ids.append(d)
                    ids.append(np.frombuffer(x, own.dtype))
                    held += len(ids[-1])
                    if held >= block:
                        yield close()
                        nth, first, held = nth + 1, first + held, 0
                        doc_ids, ids = [], []
        if doc_ids:
            yield close()

    (dealt.mapInArrow(run, "part int, nth int, first long, n_tokens long, block binary")
     .write.parquet(path))


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """``(start, n_tokens, block)``: the written blocks and their first token's
    place among all.  Totals of parts are added up; there is one row for each
    task of the write, so they may be broadcast."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    bases = totals.select("part", (F.sum("part_tokens").over(order) - F.col("part_tokens")).alias("base"))
    return files.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("first")).alias("start"), "n_tokens", "block")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document written, from
    its ids read back from the blocks."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, data in zip(b.column(0).to_pylist(), b.column(1)):
                one = Block(data.as_buffer())
                cuts = [0, *one.ends.tolist()]
                sums = [crc32(one.tokens(x, y).astype("<u4").tobytes()) for x, y in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.doc_ids, pa.int64()), pa.array([start + x for x in cuts[:-1]], pa.int64()),
                     pa.array(np.diff(cuts).tolist(), pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks(spark, path).select("start", "block").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``(position, token)`` for each distinct value of the column ``position``
    that is a place among all tokens; only the addressed ids are read."""
    found = blocks(spark, path)
    spans = found.select("start", "n_tokens", F.explode(F.sequence(
        F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("n_tokens") - 1) / BLOCK))).alias("slot"))
    asked = positions.select("position").distinct().withColumn("slot", F.floor(F.col("position") / BLOCK))
    # distinct positions of one block are at most its tokens
    wanted = (asked.join(spans, "slot")
              .where("position >= start and position < start + n_tokens")
              .groupBy("start").agg(F.collect_list("position").alias("positions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, places, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                one = Block(data.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int64()), pa.array([one.token(p - start) for p in places], pa.int64())],
                    names=["position", "token"])

    return (found.join(wanted, "start").select("start", "positions", "block")
            .mapInArrow(run, "position long, token long"))


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` to the run folder and return
    :func:`read_documents` of them: a row per row of ``docs``, also for null or
    empty texts (the end id alone) and repeated rows; none for an empty table.
    """
    spark = docs.sparkSession
    path = f"{run_folder(spark)}/dac-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer)
    return read_documents(spark, path)
