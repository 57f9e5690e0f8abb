"""Vertical mining on tid bitsets: ECLAT (MINE-3, MINE-4, MINE-9).

A tidset is stored as long rows ``(item, word, bits)``: word ``w`` holds
transactions ``64*w .. 64*w+63`` of the dense tid numbering as one BIGINT
(AGG-8).  Support is ``sum(bit_count(bits))`` (AGG-9).  A (k+1)-set's
tidset is the AND of two k-sets that share a prefix, word by word (JN-4):
a skew-safe self-join on ``(prefix, word)`` with ``a.last < b.last``,
dropping words that become zero.  Rows are keyed by word, so a frequent item
spreads over as many tasks as it has words and a big basket adds one bit per
item instead of a quadratic pair list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bit_mask, bit_word, empty_array, popcount
from ..session import Store, broadcast_if_small, release
from .apriori import _stop_level, level_result, select_report
from .encode import dense_ids
from .groupjoin import DEFAULT_MAX_GROUP, pairs_within
from .listed import join_listed
from .support import distinct_rows, frequent, keep_items, pair_occurrences, prepare


def tid_bitsets(rows: DataFrame, tid: str = "tid", item: str = "item",
                dense: bool = True, already_distinct: bool = False) -> DataFrame:
    """``(item, word, bits)`` from long rows (AGG-8).

    ``dense=True`` renumbers transactions ``0..n-1`` first; ``False`` uses an
    integral, non-negative ``tid`` as it is.
    """
    return _bitsets(rows, tid, item, dense, already_distinct)[0]


def _bitsets(rows: DataFrame, tid: str, item: str, dense: bool,
             already_distinct: bool) -> tuple[DataFrame, DataFrame | None]:
    """Bitsets and the dense-id table they read (to release once written)."""
    if not already_distinct:
        rows = distinct_rows(rows, tid, item)
    ids = None
    if dense:
        ids = dense_ids(rows.select(tid).distinct(), None, "_dtid", start=0)
        rows = rows.join(ids, tid, "inner")
        t = F.col("_dtid")
    else:
        t = F.col(tid).cast("bigint")
    bits = (rows.groupBy(F.col(item), bit_word(t).alias("word"))
            .agg(F.bit_or(bit_mask(t)).alias("bits")))
    return bits, ids


def merge_tidsets(bitsets: DataFrame, keys=("itemset",)) -> DataFrame:
    """OR together the tidsets of equal itemsets, word by word (AGG-10,
    SET-4); only needed when one itemset was built along several paths."""
    return bitsets.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def tid_bitmaps(rows: DataFrame, tid: str = "tid", item: str = "item",
                already_distinct: bool = False) -> DataFrame:
    """``(item, bucket, bitmap)``: tidsets as Spark's bitmaps, one value for
    32,768 transactions (AGG-8).  Where an item is in most baskets this is one
    row in place of 512 words; rare items are better off with
    :func:`tid_bitsets`.  Transactions are renumbered from 1 first.
    """
    if not already_distinct:
        rows = distinct_rows(rows, tid, item)
    ids = dense_ids(rows.select(tid).distinct(), None, "_dtid", start=1)
    return (rows.join(ids, tid).groupBy(F.col(item), F.bitmap_bucket_number("_dtid").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_dtid")).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame, keys=("itemset",)) -> DataFrame:
    """OR together the bitmaps of equal keys, bucket by bucket (AGG-10, SET-4)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_support(bitmaps: DataFrame, keys=("item",)) -> DataFrame:
    """``(keys..., support)`` = number of set bits (AGG-9)."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias("support"))


def bitset_support(bitsets: DataFrame, keys=("item",)) -> DataFrame:
    """``(keys..., support)`` = number of set bits (AGG-9)."""
    return bitsets.groupBy(*keys).agg(F.sum(popcount("bits")).cast("bigint").alias("support"))


def _pair_tidsets(tids: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tidset words of the given pairs from those of single items."""
    keys = broadcast_if_small(pairs.select(F.col("prefix")[0].alias("_a"), F.col("last").alias("_b")))
    a = tids.select(F.col("last").alias("_a"), "word", F.col("bits").alias("bits_a"))
    b = tids.select(F.col("last").alias("_b"), "word", F.col("bits").alias("bits_b"))
    return (a.join(keys, "_a").join(b, ["_b", "word"])
            .select(F.array("_a").alias("prefix"), F.col("_b").alias("last"), "word",
                    F.col("bits_a").bitwiseAND(F.col("bits_b")).alias("bits"))
            .where(F.col("bits") != 0))


def eclat(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
          max_len: int | None = None, report: str = "all", k: int | None = None,
          dense: bool = True, max_group: int = DEFAULT_MAX_GROUP,
          min_basket_size: int | None = None, num_partitions: int | None = None,
          n_baskets: int | None = None, resume: str | None = None) -> DataFrame:
    """Frequent itemsets by tidset intersection; same contract and result as
    :func:`cofreq.operators.apriori.apriori`, ``resume`` included.

    Pairs are counted where they occur, in baskets: items of one 64-transaction
    word that share no basket never meet.  From size 3 on words are
    intersected, of pairs known to be frequent only.
    """
    store = Store(rows.sparkSession, resume, dict(
        min_support=min_support, tid=tid, item=item, dense=dense,
        min_basket_size=min_basket_size, n_baskets=n_baskets))
    prep = prepare(rows, min_support, tid, item, min_basket_size=min_basket_size,
                   num_partitions=num_partitions, n_baskets=n_baskets, store=store)
    m = prep.threshold
    item_type = prep.rows.schema[item].dataType
    stop = _stop_level(max_len, report, k)

    ids = None

    def all_bits() -> DataFrame:
        nonlocal ids
        found, ids = _bitsets(prep.rows, tid, item, dense, already_distinct=True)
        return found

    bits, _ = store.write(all_bits, "bitsets")
    release(ids)
    l1, size = store.write(frequent(bitset_support(bits, [item]), m)
                           .select(empty_array(item_type).alias("prefix"),
                                   F.col(item).alias("last"), "support"), "level-1")
    levels = [l1]
    tids, _ = store.write(
        join_listed(bits, l1.select(F.col("last").alias(item)), item, bound=size)
        .select(empty_array(item_type).alias("prefix"), F.col(item).alias("last"), "word", "bits"), "tids-1")
    # A (prefix, word) group never holds more items than the word held at
    # level 1, so one measurement bounds every level.
    widest = store.value("widest-word", lambda: tids.groupBy("word").count().agg(F.max("count")).first()[0] or 0)
    check = widest > max_group
    level = 1
    if size > 1 and (stop is None or stop > 1):
        kept = keep_items(prep.rows, l1.select(F.col("last").alias(item)), item, bound=size)
        occ = pair_occurrences(kept, tid, item, max_group, check_hot=prep.max_basket > max_group)
        l2, size = store.write(frequent(occ.groupBy("item1", "item2")
                                        .agg(F.count(F.lit(1)).alias("support")), m)
                               .select(F.array("item1").alias("prefix"), F.col("item2").alias("last"),
                                       "support"), "level-2")
        if size:
            levels.append(l2)
            level = 2
        if size > 1 and (stop is None or stop > 2):
            done = tids
            tids, _ = store.write(_pair_tidsets(tids, l2), "tids-2")
            release(done)
    while level > 1 and size > 1 and (stop is None or level < stop):
        pairs = pairs_within(tids, ["prefix", "word"], "last", payload=["bits"],
                             max_group=max_group, check_hot=check)
        # written once: the level is counted from the file, and the next
        # tidsets are the file's rows that match the level
        cand, _ = store.write(
            pairs.select(F.concat("prefix", F.array("last_a")).alias("prefix"),
                         F.col("last_b").alias("last"), "word",
                         F.col("bits_a").bitwiseAND(F.col("bits_b")).alias("bits"))
            .where(F.col("bits") != 0), f"candidates-{level + 1}")
        nxt, size = store.write(frequent(bitset_support(cand, ["prefix", "last"]), m), f"level-{level + 1}")
        if size:
            levels.append(nxt)
            level += 1
            if size > 1 and (stop is None or level < stop):
                done = tids
                tids, _ = store.write(join_listed(cand, nxt.select("prefix", "last"), ["prefix", "last"], bound=size),
                                      f"tids-{level}")
                release(done)
        release(cand)
        if not size:
            break
    release(tids, bits, prep.rows)
    out = level_result(levels)
    return select_report(out, report, k, out[0])
