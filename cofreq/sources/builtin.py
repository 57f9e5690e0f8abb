"""Built-in sample data used when no input path is given (SRC-2, SRC-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import comma_items

# The five default baskets.
DEFAULT_BASKETS = ["1 3 4", "2 3 5", "1 2 3 5", "2 5", "1 3 5"]

# The eight sample customer transactions (cid, tid, items).
CUSTOMER_TRANSACTIONS = [
    (1, 1, "1,3,4"), (1, 2, "2,3,5"), (1, 3, "1,2,3,5"), (1, 4, "2,5"), (1, 5, "1,3,5"),
    (2, 6, "1,3,4,5"), (2, 7, "3,5"), (2, 8, "1,4,5"),
]


def default_baskets(spark: SparkSession) -> DataFrame:
    """``(tid BIGINT, items ARRAY<INT>)`` for the five default baskets."""
    df = spark.createDataFrame([(i, s) for i, s in enumerate(DEFAULT_BASKETS)],
                               "tid BIGINT, line STRING")
    return df.select("tid", F.split("line", " ").cast("array<int>").alias("items"))


def customer_transactions(spark: SparkSession) -> DataFrame:
    """``(cid INT, tid INT, items ARRAY<INT>)``; the item list is parsed
    leniently from its comma-joined text (SRC-4)."""
    df = spark.createDataFrame(CUSTOMER_TRANSACTIONS, "cid INT, tid INT, item_list STRING")
    return df.select("cid", "tid", comma_items("item_list").alias("items"))
