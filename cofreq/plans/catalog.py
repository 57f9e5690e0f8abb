"""Baskets defined over the driver's tables.

Each function returns long rows ``(tid, item[, order columns])``.  Only the
needed columns are selected, so the parquet scans are pruned to them; the
dimension join is left to Spark (broadcast only when its size statistics
allow, shuffle otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens

# Fixed value: words of a document are separated by blanks, tabs and line breaks.
WORD_SEPARATORS = "[ \t\n\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_part_rows(spark: SparkSession, sf_dir: str, attr: str,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """``(tid = l_orderkey, item = part.<attr>, *extra)``, one row per line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *extra)
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(attr).alias("item"))
    return (li.join(part, li.l_partkey == part.p_partkey, "inner")
            .select(F.col("l_orderkey").alias("tid"), "item", *extra))


def order_brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_part_rows(spark, sf_dir, "p_brand")


def order_type_rows(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return order_part_rows(spark, sf_dir, "p_type", extra)


def order_column_rows(spark: SparkSession, sf_dir: str, col: str) -> DataFrame:
    """Baskets of a lineitem column, e.g. ``l_partkey`` or ``l_suppkey``."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tid"),
                                                   F.col(col).alias("item"))


def daily_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tid = (user_id, day), item = event_type, ts, event_id)``."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    tid = F.struct(F.col("user_id"), F.to_date("ts").alias("day"))
    return ev.select(tid.alias("tid"), F.col("event_type").alias("item"), "ts", "event_id")


def document_word_rows(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    """``(tid = doc_id, item = word)`` over the whole text of every document.

    ``distinct`` drops the repeated words of a table row before they become
    rows.  An id may stand on several table rows, so the result is not yet a
    set.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("text").isNotNull())
    words = tokens("text", WORD_SEPARATORS)
    return (docs.where(F.col("doc_id").isNotNull())
            .select(F.col("doc_id").alias("tid"),
                    F.explode(F.array_distinct(words) if distinct else words).alias("item")))
