"""Sinks: basket text lines and result tables (SNK-1..3).

Everything is written by the executors; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_baskets_text(baskets: DataFrame, path: str, items: str = "items",
                       sep: str = " ", mode: str = "overwrite") -> None:
    """One line per basket, items joined by ``sep``: ``' '`` for code
    baskets (SNK-1), ``', '`` for integer-coded baskets (SNK-2)."""
    line = F.concat_ws(sep, F.col(items).cast("array<string>"))
    baskets.select(line.alias("value")).write.mode(mode).text(path)


def write_itemsets(itemsets: DataFrame, path: str, fmt: str = "parquet",
                   mode: str = "overwrite", by_level: bool = False) -> None:
    """Write a result table ``(itemset, k, support)`` (SNK-3); ``fmt='text'``
    writes ``item item ...: support`` lines.  ``by_level`` puts every size in a
    folder of its own, so :func:`read_itemsets` opens the files of one level
    only."""
    if fmt == "text":
        line = F.concat(F.concat_ws(" ", F.col("itemset").cast("array<string>")),
                        F.lit(": "), F.col("support").cast("string"))
        itemsets = itemsets.select(line.alias("value"), *(["k"] if by_level else []))
    out = itemsets.write.mode(mode)
    (out.partitionBy("k") if by_level else out).format(fmt).save(path)


def read_itemsets(spark: SparkSession, path: str, k: int | None = None) -> DataFrame:
    """A result table that :func:`write_itemsets` wrote as Parquet; with ``k``
    the itemsets of that size, by partition pruning where they lie by level."""
    found = spark.read.parquet(path).select("itemset", F.col("k").cast("int").alias("k"), "support")
    return found if k is None else found.where(F.col("k") == k)
