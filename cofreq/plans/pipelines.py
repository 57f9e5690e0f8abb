"""End-to-end basket analysis jobs (PIPE-1..5).

All of them are ``read -> clean -> encode -> mine -> decode`` over long
rows; nothing is collected.  Column positions and separators of the input
files are fixed values of the formats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.apriori import apriori
from ..operators.encode import build_dictionary, decode, encode, encoded_rows
from ..operators.ordered import ordered_patterns
from ..operators.prepare import clean_rows, ordered_baskets, to_baskets
from ..session import materialize
from ..sources.delimited import read_delimited
from ..sources.sinks import write_baskets_text

# Point-of-sale export, '|'-separated with a header and 75
# columns; the transaction number, the time and the article code are at
# positions 0, 13 and 35.
POS_SEP = "|"
POS_N_COLUMNS = 75
POS_COLUMNS = {"RPA_TNR": 0, "RPA_BTS": 13, "EANUPC": 35}

# Online-retail export, ','-separated with a header; invoice,
# stock code and invoice date are at positions 0, 1 and 4.
RETAIL_N_COLUMNS = 8
RETAIL_COLUMNS = {"InvoiceNo": 0, "StockCode": 1, "InvoiceDate": 4}


def basket_analysis(rows: DataFrame, min_support, *, tid: str, item: str,
                    max_len: int | None = None, report: str = "all", k: int | None = None,
                    numeric_only: bool = False) -> DataFrame:
    """Clean rows, encode items densely, mine, decode: ``(itemset ARRAY<STRING>,
    k, support)`` with items in natural order."""
    clean = clean_rows(rows, tid, item, numeric_only=numeric_only) \
        .select(F.col(tid).alias("tid"), F.col(item).alias("item"))
    enc, dictionary = encoded_rows(clean, "tid", "item", order="asc")
    return _mine_encoded(enc, dictionary, min_support, max_len, report, k)


def _mine_encoded(enc: DataFrame, dictionary: DataFrame, min_support, max_len: int | None,
                  report: str, k: int | None) -> DataFrame:
    # encoding keeps rows distinct
    res = apriori(enc, min_support, item="item_id", max_len=max_len, report=report, k=k,
                  already_distinct=True)
    return decode(res, dictionary, item="item", item_id="item_id", sort=True)


def ordered_analysis(rows: DataFrame, min_support, *, tid: str, item: str, ts: str,
                     max_len: int | None = None, report: str = "all", k: int | None = None,
                     parse_time: bool = True) -> DataFrame:
    """Time-ordered patterns (MINE-10) after cleaning rows with a valid time
    (PRJ-11, PRJ-12); ties in time are broken by the item.  Items are encoded,
    mined and decoded (ENC-1..3)."""
    clean = materialize(
        clean_rows(rows, tid, item, ts, parse_time=parse_time)
        .select(F.col(tid).alias("tid"), F.col(item).alias("item"), F.col(ts).alias("ts")), "clean")
    dictionary = materialize(build_dictionary(clean, order="asc"), "dictionary")
    enc = encode(clean.withColumn("name", F.col("item")), dictionary)
    res = ordered_patterns(enc, min_support, item="item_id", order=("ts", "name"),
                           max_len=max_len, report=report, k=k)
    return decode(res, dictionary, itemset="pattern", sort=False)


def pos_basket_analysis(spark: SparkSession, path: str, min_support, **kw) -> DataFrame:
    """PIPE-1: point-of-sale file, baskets = transaction, items = article."""
    rows = read_delimited(spark, path, POS_COLUMNS, sep=POS_SEP, n_columns=POS_N_COLUMNS)
    return basket_analysis(rows, min_support, tid="RPA_TNR", item="EANUPC", **kw)


def csv_basket_analysis(spark: SparkSession, path: str, min_support,
                        tid: str, item: str, **kw) -> DataFrame:
    """PIPE-2: two-column comma file with a header."""
    rows = read_delimited(spark, path, [tid, item], sep=",")
    return basket_analysis(rows, min_support, tid=tid, item=item, **kw)


def retail_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, RETAIL_COLUMNS, sep=",", n_columns=RETAIL_N_COLUMNS)


def retail_basket_analysis(spark: SparkSession, path: str, min_support,
                           encoded_out: str | None = None, **kw) -> DataFrame:
    """PIPE-3: invoices as baskets of stock codes; optionally writes the
    integer-coded baskets as ``', '``-joined lines (SNK-2)."""
    rows = retail_rows(spark, path)
    if not encoded_out:
        return basket_analysis(rows, min_support, tid="InvoiceNo", item="StockCode", **kw)
    clean = clean_rows(rows, "InvoiceNo", "StockCode",
                       numeric_only=kw.pop("numeric_only", False)) \
        .select(F.col("InvoiceNo").alias("tid"), F.col("StockCode").alias("item"))
    enc, dictionary = encoded_rows(clean, order="asc")
    enc = materialize(enc, "encoded")
    write_baskets_text(to_baskets(enc, item="item_id"), encoded_out, sep=", ")
    return _mine_encoded(enc, dictionary, min_support, kw.get("max_len"),
                         kw.get("report", "all"), kw.get("k"))


def retail_ordered_analysis(spark: SparkSession, path: str, min_support, **kw) -> DataFrame:
    """PIPE-4: invoices with a valid date, items in time order, order-aware
    patterns."""
    return ordered_analysis(retail_rows(spark, path), min_support, tid="InvoiceNo",
                            item="StockCode", ts="InvoiceDate", **kw)


def retail_prepare(spark: SparkSession, path: str, out: str | None = None,
                   numeric_only: bool = False, time_ordered: bool = False) -> DataFrame:
    """PIPE-5: preparation only -- cleaned invoices as baskets of codes,
    written as blank-separated lines (SNK-1) when ``out`` is given."""
    rows = retail_rows(spark, path)
    if time_ordered:
        clean = clean_rows(rows, "InvoiceNo", "StockCode", "InvoiceDate",
                           numeric_only=numeric_only)
        first = clean.groupBy("InvoiceNo", "StockCode").agg(
            F.min("InvoiceDate").alias("InvoiceDate"))
        baskets = ordered_baskets(first, "InvoiceNo", "StockCode", ["InvoiceDate"])
    else:
        clean = clean_rows(rows, "InvoiceNo", "StockCode", numeric_only=numeric_only)
        baskets = to_baskets(clean, "InvoiceNo", "StockCode")
    baskets = baskets.withColumnRenamed("InvoiceNo", "tid")
    if out:
        write_baskets_text(baskets, out, sep=" ")
    return baskets


__all__ = ["basket_analysis", "ordered_analysis", "pos_basket_analysis",
           "csv_basket_analysis", "retail_basket_analysis", "retail_ordered_analysis",
           "retail_prepare"]
