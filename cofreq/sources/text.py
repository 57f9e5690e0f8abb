"""Basket text files: one basket per line, items separated by blanks (SRC-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import BLANKS, cast_items, tokens


def read_baskets(spark: SparkSession, path: str, item_type: str = "int", *,
                 sep: str = BLANKS, lenient: bool = False, keep_empty: bool = False,
                 min_partitions: int | None = None) -> DataFrame:
    """``(tid BIGINT, items ARRAY<item_type>)``, one row per line.

    Tokens are split on ``sep`` with empty tokens removed (PRJ-1); with
    ``item_type`` ``'int'`` or ``'bigint'`` a token that is no such number
    raises, or is dropped when ``lenient``.  Duplicates inside a line are kept here
    (occurrence counting needs them); miners treat baskets as sets.  ``tid``
    is unique (not dense).  ``min_partitions`` re-partitions the lines
    (SRC-6).  Empty lines are dropped unless ``keep_empty``; long rows can't
    hold them, so a share of all lines needs :func:`count_lines`.
    """
    lines = spark.read.text(path)
    if min_partitions:
        lines = lines.repartition(int(min_partitions))
    toks = tokens("value", sep)
    items = toks if item_type == "string" else cast_items(toks, item_type, lenient)
    out = lines.select(F.monotonically_increasing_id().alias("tid"), items.alias("items"))
    if not keep_empty:
        out = out.where(F.size("items") > 0)
    return out


def count_lines(spark: SparkSession, path: str) -> int:
    """All lines of a basket file, empty ones included: the ``n_baskets`` that
    a relative support of the miners is a share of."""
    return spark.read.text(path).count()


def baskets_to_rows(baskets: DataFrame, tid: str = "tid", items: str = "items",
                    item: str = "item") -> DataFrame:
    """Explode baskets to long rows ``(tid, item)`` (PRJ-4)."""
    return baskets.select(tid, F.explode(items).alias(item))


def read_rows(spark: SparkSession, path: str, item_type: str = "int", **kw) -> DataFrame:
    """Basket text file as long rows ``(tid, item)``."""
    return baskets_to_rows(read_baskets(spark, path, item_type, **kw))
