"""Row cleaning and basket building (PRJ-11..13, AGG-6, AGG-7, AGG-13).

The miners take long rows; these helpers clean raw rows and, for sinks and
library wrappers that need them, build one array per basket.  A basket array
is one row, so its size is that of the user's basket: the miners themselves
never build it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import retail_time


def clean_rows(df: DataFrame, tid: str, item: str, ts: str | None = None, *,
               numeric_only: bool = False, parse_time: bool = True) -> DataFrame:
    """Drop rows with a null or blank transaction id or item (PRJ-11); kept
    ids and items stay as they are, as text.

    ``ts``: keep only rows whose time matches ``MM/dd/yyyy HH:mm:ss`` and
    parse it (PRJ-12) unless ``parse_time=False`` (already a timestamp).
    ``numeric_only`` keeps items made of digits and ``:`` only (PRJ-13).
    """
    out = df.withColumn(tid, F.col(tid).cast("string")) \
        .withColumn(item, F.col(item).cast("string"))
    cond = (F.col(tid).isNotNull() & (F.trim(tid) != "")
            & F.col(item).isNotNull() & (F.trim(item) != ""))
    if numeric_only:
        cond = cond & F.col(item).rlike("^[0-9:]+$")
    out = out.where(cond)
    if ts is not None:
        if parse_time:
            out = out.withColumn(ts, retail_time(F.col(ts)))
        out = out.where(F.col(ts).isNotNull())
    return out


def to_baskets(rows: DataFrame, tid: str = "tid", item: str = "item",
               items: str = "items") -> DataFrame:
    """``(tid, items)`` with each basket's distinct items sorted (AGG-6,
    PRJ-2, PRJ-3)."""
    return rows.groupBy(tid).agg(F.array_sort(F.collect_set(item)).alias(items))


def ordered_baskets(rows: DataFrame, tid: str, item: str, order: Sequence[str],
                    items: str = "items") -> DataFrame:
    """``(tid, items)`` with items in the order of ``order`` (AGG-7, SRT-3);
    the item itself breaks remaining ties so the result is deterministic."""
    key = F.struct(*[F.col(c) for c in order], F.col(item).alias("_item"))
    return rows.groupBy(tid).agg(
        F.transform(F.array_sort(F.collect_list(key)), lambda r: r["_item"]).alias(items))


def profile(rows: DataFrame, tid: str = "tid", item: str = "item") -> DataFrame:
    """Row, basket, item and basket-size counts as one row (AGG-13); the rows
    are aggregated twice, by basket and by item."""
    per_basket = (rows.groupBy(tid).agg(F.count(F.lit(1)).alias("_rows"),
                                        F.count_distinct(item).alias("_items")))
    basket_side = per_basket.agg(
        F.sum("_rows").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_baskets"),
        F.sum("_items").cast("bigint").alias("n_basket_items"),
        F.max("_items").cast("bigint").alias("max_basket"))
    item_side = rows.select(item).distinct().agg(F.count(F.lit(1)).cast("bigint").alias("n_items"))
    # two single-row aggregates stacked and folded into one row (no join)
    both = basket_side.unionByName(item_side, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in
                      ["n_rows", "n_baskets", "n_items", "n_basket_items", "max_basket"]])
