"""Joins of long rows with a lookup list: frequent items, frequent pairs,
codes (JN-6, PRJ-5).

A list within the broadcast limit is broadcast.  A longer one has to be
shuffled with the rows, so rows that match nothing are dropped first by a
Bloom filter, which is small enough to broadcast long after the list is not.

The filter is blocked by words: a key sets three bits of one 64-bit word, so a
row is tested with a single lookup.  It is built by a hash aggregate
(``bit_or`` of masks by word) and read by a broadcast hash join, all on
built-in functions.  Rows that pass by chance fall to the exact join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, TimestampType

from ..session import measured

#: Bits of the filter for each key: about 4 % of other keys pass.
BITS_PER_KEY = 8
#: Below this many bits half of all rows would pass, and no filter is built.
LEAST_BITS = 2
#: Words of the largest filter (16 MB, whatever the list's size) and of one row
#: of its table.
MAX_WORDS, ROW_WORDS = 1 << 21, 64


def _long(x) -> Column:
    return F.lit(x).cast("bigint")


def _word(on: list[str], n_words: int) -> Column:
    return F.pmod(F.xxhash64(*on), _long(n_words))


def _mask(on: list[str]) -> Column:
    """Three bits from a second hash of the key."""
    h = F.xxhash64(F.lit(1), *on)
    bits = [F.call_function("shiftleft", _long(1), F.shiftrightunsigned(h, 6 * i).bitwiseAND(_long(63)).cast("int"))
            for i in range(3)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def bloom_filter(keys: DataFrame, on: list[str], n_words: int) -> DataFrame:
    """``(_chunk, _words)``: the filter's words, ``ROW_WORDS`` to a row."""
    words = keys.groupBy(_word(on, n_words).alias("_word")).agg(F.bit_or(_mask(on)).alias("_bits"))
    slot = F.pmod("_word", _long(ROW_WORDS)).cast("int")
    chunks = (words.groupBy(F.floor(F.col("_word") / ROW_WORDS).alias("_chunk"))
              # at most ROW_WORDS entries, as words are distinct
              .agg(F.map_from_entries(F.collect_list(F.struct(slot, "_bits"))).alias("_set")))
    return chunks.select("_chunk", F.transform(
        F.sequence(F.lit(0), F.lit(ROW_WORDS - 1)),
        lambda i: F.coalesce(F.try_element_at("_set", i), _long(0))).alias("_words"))


def bloom_prefilter(rows: DataFrame, keys: DataFrame, on: list[str], n_keys: int) -> DataFrame:
    """``rows`` without most of those whose ``on`` is not among ``keys``, before
    any shuffle; never without one that is.

    Rows pass unfiltered where ``n_keys`` leaves too few bits a key, or where
    the two sides' types differ or could be equal with different hashes.
    """
    kinds = (IntegralType, StringType, DateType, TimestampType)
    alike = all(rows.schema[c].dataType == keys.schema[c].dataType and isinstance(rows.schema[c].dataType, kinds)
                for c in on)
    if not alike or n_keys * LEAST_BITS > MAX_WORDS * 64:
        return rows
    n_words = min(MAX_WORDS, max(1, math.ceil(n_keys * BITS_PER_KEY / 64)))
    word, mask = _word(on, n_words), _mask(on)
    table = F.broadcast(bloom_filter(keys.select(*on), on, n_words))
    hit = F.get("_words", F.pmod(word, _long(ROW_WORDS)).cast("int")).bitwiseAND(mask) == mask
    return (rows.withColumn("_chunk", F.floor(word / ROW_WORDS)).join(table, "_chunk")
            .where(hit).select(*rows.columns))


def join_listed(rows: DataFrame, listed: DataFrame, on: str | list[str], how: str = "left_semi",
                bound: int | None = None, limit: int | None = None) -> DataFrame:
    """``rows`` joined (``left_semi`` or ``inner``) with a list: broadcast if
    its size, proven by ``bound`` or measured, is within ``limit`` bytes, else
    a shuffle join of the rows that a Bloom filter of the list lets pass."""
    if how not in ("left_semi", "inner"):
        raise ValueError("how must be 'left_semi' or 'inner'")
    on = [on] if isinstance(on, str) else list(on)
    small, n_keys = measured(listed, limit, bound)
    if small:
        return rows.join(F.broadcast(listed), on, how)
    return bloom_prefilter(rows, listed, on, n_keys).join(listed, on, how)
