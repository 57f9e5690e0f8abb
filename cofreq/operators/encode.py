"""Dictionary encoding and transaction ids (ENC-1..4).

Dense ids are computed without a global single-task window: the table is
range-partitioned and sorted by Spark, ``monotonically_increasing_id`` gives
each row its partition number and its position inside the partition, and a
per-partition offset (one row per partition, so its size is bounded by the
partition count) turns that into a dense global id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import broadcast_if_small, materialize
from .support import distinct_rows, item_support

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def dense_ids(df: DataFrame, order: Sequence[Column] | None, id_col: str = "id",
              start: int = 1) -> DataFrame:
    """Add ``id_col`` = ``start, start+1, ...`` following ``order`` (a total
    order, so ids are deterministic).  With ``order=None`` the ids are dense
    and unique in whatever order the partitions hold, with no sort at all;
    they are fixed once written."""
    src = df.orderBy(*order) if order else df
    ranked = materialize(src.withColumn("_mid", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    offsets = F.broadcast(offsets.fillna(0, ["_off"]))  # one row per partition
    out = (ranked.join(offsets, part == F.col("_part"))
           .withColumn(id_col, (F.col("_off") + local + F.lit(start)).cast("bigint"))
           .drop("_mid", "_part", "_off"))
    out._cofreq_path = ranked._cofreq_path  # release(out) frees the written ranking
    return out


def build_dictionary(rows: DataFrame, tid: str = "tid", item: str = "item",
                     order: str = "desc", start: int = 1,
                     already_distinct: bool = False) -> DataFrame:
    """``(item, item_id, support)``: one dense id per distinct item (ENC-1).

    ``order='desc'`` numbers the most frequent item first, ``'asc'`` the
    rarest first (rare prefixes keep the miners' groups small); ties by item.
    """
    sup = item_support(rows, tid, item, already_distinct=already_distinct)
    first = F.desc("support") if order == "desc" else F.asc("support")
    return dense_ids(sup, [first, F.asc(item)], "item_id", start) \
        .select(item, "item_id", "support")


def encode(rows: DataFrame, dictionary: DataFrame, item: str = "item",
           item_id: str = "item_id") -> DataFrame:
    """Replace ``item`` by its id (ENC-2); the dictionary is broadcast only
    when its measured size allows.  An item that the dictionary lacks stops
    the job."""
    d = broadcast_if_small(dictionary.select(item, F.col(item_id).alias("_id")))
    known = F.coalesce("_id", F.raise_error(F.concat(
        F.lit("item not in the dictionary: "), F.coalesce(F.col(item).cast("string"), F.lit("null")))))
    return rows.join(d, item, "left").withColumn(item_id, known).drop(item, "_id")


def decode(itemsets: DataFrame, dictionary: DataFrame, itemset: str = "itemset",
           item: str = "item", item_id: str = "item_id", sort: bool = True) -> DataFrame:
    """Map id arrays back to items (ENC-3), keeping every other column.

    ``sort=True`` returns the items in natural order (set semantics);
    ``False`` keeps the order of the ids (ordered patterns).  Every row is
    decoded by itself, equal rows too; an empty array stays empty and null stays
    null.  An id that the dictionary lacks stops the job.
    """
    others = [c for c in itemsets.columns if c != itemset]
    d = broadcast_if_small(dictionary.select(F.col(item_id).alias("_id"),
                                             F.col(item).alias("_item")))
    # written, so that a row keeps its number whatever is computed again
    rows = materialize(itemsets.select(
        F.monotonically_increasing_id().alias("_row"), F.struct(*others).alias("_others") if others
        else F.lit(True).alias("_others"), F.col(itemset).alias("_key")), "decode")
    exploded = rows.select("_row", F.posexplode("_key").alias("_pos", "_id"))
    known = F.coalesce("_item", F.raise_error(F.concat(
        F.lit("id not in the dictionary: "), F.coalesce(F.col("_id").cast("string"), F.lit("null")))))
    regrouped = (exploded.join(d, "_id", "left").withColumn("_item", known).groupBy("_row")
                 .agg(F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_pairs")))
    items = F.transform("_pairs", lambda p: p["_item"])
    whole = F.when(F.size("_key") == 0, F.array().cast(ArrayType(dictionary.schema[item].dataType))).otherwise(
        F.array_sort(items) if sort else items)
    return (rows.join(regrouped, "_row", "left")
            .select(whole.alias(itemset), *[F.col("_others")[c].alias(c) for c in others]))


def encoded_rows(rows: DataFrame, tid: str = "tid", item: str = "item",
                 order: str = "asc") -> tuple[DataFrame, DataFrame]:
    """Distinct rows with items replaced by dense ids; returns
    ``(rows(tid, item_id), dictionary)``."""
    rows = materialize(distinct_rows(rows, tid, item), "rows")
    dictionary = materialize(build_dictionary(rows, tid, item, order, already_distinct=True),
                             "dictionary")
    return encode(rows, dictionary, item), dictionary
