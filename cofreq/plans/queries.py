"""The query catalogue over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps).  Thresholds
are shares of the baskets compared in integers (``support * den >= num *
n``), so Spark and the oracle agree exactly.  Itemsets are reported as
``'|'``-joined sorted text, or as ``item1, item2, ...`` columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import add_item, contains_all, intersect, itemset_text
from ..operators.apriori import apriori, r_apriori
from ..operators.candidates import candidates, count_containment, items_in_candidates
from ..operators.eclat import (bitmap_support, bitset_support, eclat, merge_bitmaps, merge_tidsets,
                               tid_bitmaps, tid_bitsets)
from ..operators.encode import build_dictionary, encode
from ..operators.fpgrowth import fpgrowth
from ..operators.ordered import ordered_patterns
from ..operators.prepare import profile, to_baskets
from ..operators.rules import association_rules
from ..operators.support import (basket_stats, distinct_rows, frequent, item_support,
                                  min_count, pair_support, trim_baskets)
from ..session import materialize, run_folder
from ..sources import (count_lines, read_baskets, read_itemsets, read_rows, write_baskets_text,
                       write_itemsets)
from . import catalog as C
from .pipelines import (POS_COLUMNS, POS_N_COLUMNS, POS_SEP, basket_analysis,
                        csv_basket_analysis, pos_basket_analysis, retail_basket_analysis,
                        retail_ordered_analysis, retail_prepare)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------------ SQL parts

BRAND = "SELECT DISTINCT l_orderkey AS tid, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey"
TYPE = "SELECT DISTINCT l_orderkey AS tid, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey"
N = "n AS (SELECT count(DISTINCT tid) AS n FROM b)"


def _all_itemsets_sql(baskets: str, num: int, den: int) -> str:
    """Every frequent itemset by brute force: all subsets of every basket."""
    return f"""
WITH RECURSIVE b AS ({baskets}), {N},
s(tid, items, last) AS (
  SELECT tid, [item], item FROM b
  UNION ALL
  SELECT s.tid, list_append(s.items, b.item), b.item FROM s JOIN b ON s.tid = b.tid AND b.item > s.last)
SELECT array_to_string(items, '|') AS itemset, CAST(len(items) AS BIGINT) AS k, count(*) AS support
FROM s GROUP BY items HAVING count(*) * {den} >= {num} * (SELECT n FROM n)"""


def _pairs_sql(baskets: str, num: int, den: int) -> str:
    return f"""
WITH b AS ({baskets}), {N}
SELECT x.item AS item1, y.item AS item2, count(*) AS support
FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item
GROUP BY 1, 2 HAVING count(*) * {den} >= {num} * (SELECT n FROM n)"""


def _as_text(res: DataFrame) -> DataFrame:
    return res.select(itemset_text("itemset").alias("itemset"),
                      F.col("k").cast("bigint").alias("k"), "support")


def _as_columns(res: DataFrame, k: int) -> DataFrame:
    cols = [F.col("itemset")[i].alias(f"item{i + 1}") for i in range(k)]
    return res.where(F.col("k") == k).select(*cols, "support")


# ------------------------------------------------------------------ supports

@register("item_support", f"""
WITH b AS ({BRAND}), {N}
SELECT item, count(*) AS support FROM b GROUP BY item
HAVING count(*) * 10 >= (SELECT n FROM n)""")
def item_support_q(spark, d):
    rows = materialize(distinct_rows(C.order_brand_rows(spark, d)), "brand-rows")
    m = min_count(Fraction(1, 10), basket_stats(rows).n_baskets)
    return frequent(item_support(rows, already_distinct=True), m)


@register("item_occurrence", """
SELECT p_brand AS item, count(*) AS support FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1""")
def item_occurrence_q(spark, d):
    return item_support(C.order_brand_rows(spark, d), mode="occurrence")


@register("tidset_size", f"""
WITH b AS ({BRAND}) SELECT item, count(*) AS support FROM b GROUP BY item""")
def tidset_size_q(spark, d):
    return bitset_support(tid_bitsets(C.order_brand_rows(spark, d)), ["item"])


MERGED = f"""
WITH b AS ({BRAND})
SELECT substr(item, 1, 7) AS maker, count(DISTINCT tid) AS support FROM b GROUP BY maker"""


@register("tidset_merge", MERGED)
def tidset_merge_q(spark, d):
    """Orders with any brand of a maker: the brands' bitmaps merged."""
    maps = tid_bitmaps(C.order_brand_rows(spark, d)).withColumn("maker", F.substring("item", 1, 7))
    return bitmap_support(merge_bitmaps(maps, ["maker"]), ["maker"])


@register("tidset_merge_words", MERGED)
def tidset_merge_words_q(spark, d):
    words = tid_bitsets(C.order_brand_rows(spark, d)).withColumn("maker", F.substring("item", 1, 7))
    return bitset_support(merge_tidsets(words, ["maker"]), ["maker"])


# ------------------------------------------------------------------ baskets

@register("basket_build", f"""
WITH b AS ({TYPE})
SELECT tid, array_to_string(list_sort(list(item)), ' ') AS basket FROM b GROUP BY tid""")
def basket_build_q(spark, d):
    b = to_baskets(C.order_type_rows(spark, d))
    return b.select("tid", F.concat_ws(" ", "items").alias("basket"))


@register("basket_profile", """
WITH r AS (SELECT l_orderkey AS tid, l_partkey AS item FROM lineitem),
per AS (SELECT tid, count(*) AS c, count(DISTINCT item) AS d FROM r GROUP BY tid)
SELECT (SELECT sum(c) FROM per)::BIGINT AS n_rows, (SELECT count(*) FROM per) AS n_baskets,
       (SELECT count(DISTINCT item) FROM r) AS n_items, (SELECT sum(d) FROM per)::BIGINT AS n_basket_items,
       (SELECT max(d) FROM per) AS max_basket""")
def basket_profile_q(spark, d):
    return profile(C.order_column_rows(spark, d, "l_partkey"))


@register("basket_trim", """
WITH b AS (SELECT DISTINCT l_orderkey AS tid, l_suppkey AS item FROM lineitem), n AS (SELECT count(DISTINCT tid) AS n FROM b),
f AS (SELECT item FROM b GROUP BY item HAVING count(*) * 100 >= 4 * (SELECT n FROM n)),
k AS (SELECT b.* FROM b SEMI JOIN f USING (item)),
big AS (SELECT tid FROM k GROUP BY tid HAVING count(*) >= 2)
SELECT tid, item FROM k SEMI JOIN big USING (tid)""")
def basket_trim_q(spark, d):
    rows = materialize(distinct_rows(C.order_column_rows(spark, d, "l_suppkey")), "supp-rows")
    m = min_count(Fraction(4, 100), basket_stats(rows).n_baskets)
    items = materialize(frequent(item_support(rows, already_distinct=True), m), "items")
    return trim_baskets(rows, items, 2, already_distinct=True)


@register("basket_trim_listed", """
WITH k AS (SELECT DISTINCT l_orderkey AS tid, l_partkey AS item FROM lineitem
           WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)),
big AS (SELECT tid FROM k GROUP BY tid HAVING count(*) >= 2)
SELECT tid, item FROM k SEMI JOIN big USING (tid)""")
def basket_trim_listed_q(spark, d):
    # a list that is taken as too long to broadcast, so its Bloom filter goes ahead
    listed = C.table(spark, d, "part").where("p_size <= 10").select(F.col("p_partkey").alias("item"))
    return trim_baskets(C.order_column_rows(spark, d, "l_partkey"), listed, 2, limit=0)


@register("basket_contains", f"""
WITH b AS ({TYPE})
SELECT tid FROM b WHERE item IN ('PROMO', 'SMALL') GROUP BY tid HAVING count(*) = 2""")
def basket_contains_q(spark, d):
    wanted = F.array(F.lit("PROMO"), F.lit("SMALL"))
    return to_baskets(C.order_type_rows(spark, d)).where(contains_all("items", wanted)).select("tid")


@register("basket_intersect", f"""
WITH b AS ({TYPE})
SELECT tid, count(*) FILTER (WHERE item IN ('ECONOMY', 'LARGE', 'PROMO')) AS n_common,
       coalesce(array_to_string(list_sort(list(item) FILTER (WHERE item IN ('ECONOMY', 'LARGE', 'PROMO'))), '|'), '') AS common
FROM b GROUP BY tid""")
def basket_intersect_q(spark, d):
    wanted = F.array(F.lit("ECONOMY"), F.lit("LARGE"), F.lit("PROMO"))
    common = to_baskets(C.order_type_rows(spark, d)).withColumn("common", intersect("items", wanted))
    return common.select("tid", F.size("common").cast("bigint").alias("n_common"),
                         F.concat_ws("|", F.array_sort("common")).alias("common"))


@register("basket_add_item", f"""
WITH b AS ({TYPE})
SELECT tid, array_to_string(list_sort(list_distinct(list_append(list(item), 'PROMO'))), '|') AS items
FROM b GROUP BY tid""")
def basket_add_item_q(spark, d):
    b = to_baskets(C.order_type_rows(spark, d))
    return b.select("tid", F.concat_ws("|", add_item("items", F.lit("PROMO"))).alias("items"))


# ------------------------------------------------------------------ dictionary

DICT_SQL = f"""
WITH b AS ({BRAND}), s AS (SELECT item, count(*) AS support FROM b GROUP BY item)
SELECT item, row_number() OVER (ORDER BY support DESC, item) AS item_id, support FROM s"""


@register("item_dictionary", DICT_SQL)
def item_dictionary_q(spark, d):
    return build_dictionary(C.order_brand_rows(spark, d), order="desc")


@register("encode_baskets", f"""
WITH b AS ({BRAND}),
dct AS (SELECT item, row_number() OVER (ORDER BY support DESC, item) AS item_id
        FROM (SELECT item, count(*) AS support FROM b GROUP BY item))
SELECT b.tid, dct.item_id FROM b JOIN dct USING (item)""")
def encode_baskets_q(spark, d):
    rows = distinct_rows(C.order_brand_rows(spark, d))
    return encode(rows, build_dictionary(rows, order="desc")).select("tid", "item_id")


@register("pipeline_encoded", _pairs_sql(BRAND, 2, 100))
def pipeline_encoded_q(spark, d):
    # line rows with string ids, cleaned, encoded, mined on ids, decoded
    raw = C.order_brand_rows(spark, d).select(F.col("tid").cast("string").alias("tid"), "item")
    res = basket_analysis(raw, Fraction(2, 100), tid="tid", item="item", max_len=2,
                          report="exact_k", k=2)
    return _as_columns(res, 2)


# ------------------------------------------------------------------ pairs, triples

@register("pairs_join", _pairs_sql(BRAND, 2, 100))
def pairs_join_q(spark, d):
    return pair_support(C.order_brand_rows(spark, d), Fraction(2, 100), discard=True)


@register("pairs_no_discard", _pairs_sql(BRAND, 2, 100))
def pairs_no_discard_q(spark, d):
    return pair_support(C.order_brand_rows(spark, d), Fraction(2, 100), discard=False)


@register("r_apriori_triples", f"""
WITH b AS ({BRAND}), {N}
SELECT x.item AS item1, y.item AS item2, z.item AS item3, count(*) AS support
FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item JOIN b z ON z.tid = x.tid AND y.item < z.item
GROUP BY 1, 2, 3 HAVING count(*) * 1000 >= 3 * (SELECT n FROM n)""")
def r_apriori_triples_q(spark, d):
    res = r_apriori(C.order_brand_rows(spark, d), Fraction(3, 1000), report="exact_k", k=3)
    return _as_columns(res, 3)


@register("eclat_bitset_2", _pairs_sql(BRAND, 2, 100))
def eclat_bitset_2_q(spark, d):
    res = eclat(C.order_brand_rows(spark, d), Fraction(2, 100), report="exact_k", k=2)
    return _as_columns(res, 2)


CAND_SQL = f"""
WITH b AS ({BRAND}), {N},
l2 AS (SELECT x.item AS i1, y.item AS i2 FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item
       GROUP BY 1, 2 HAVING count(*) * 100 >= 2 * (SELECT n FROM n)),
c AS (SELECT p.i1 AS item1, p.i2 AS item2, q.i2 AS item3 FROM l2 p JOIN l2 q ON p.i1 = q.i1 AND p.i2 < q.i2
      SEMI JOIN l2 r ON r.i1 = p.i2 AND r.i2 = q.i2)"""


@register("candidate_containment", CAND_SQL + """,
t AS (SELECT x.item AS item1, y.item AS item2, z.item AS item3, count(*) AS support
      FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item JOIN b z ON z.tid = x.tid AND y.item < z.item GROUP BY 1, 2, 3)
SELECT c.item1, c.item2, c.item3, coalesce(t.support, 0) AS support FROM c LEFT JOIN t USING (item1, item2, item3)""")
def candidate_containment_q(spark, d):
    rows = materialize(distinct_rows(C.order_brand_rows(spark, d)), "brand-rows")
    l2 = apriori(rows, Fraction(2, 100), max_len=2, report="exact_k", k=2, already_distinct=True)
    counted = count_containment(rows, candidates(l2), already_distinct=True)
    return _as_columns(counted.withColumn("k", F.size("itemset")), 3)


@register("items_in_candidates", CAND_SQL + """
SELECT DISTINCT item FROM (SELECT item1 AS item FROM c UNION ALL SELECT item2 FROM c UNION ALL SELECT item3 FROM c)""")
def items_in_candidates_q(spark, d):
    l2 = apriori(C.order_brand_rows(spark, d), Fraction(2, 100), max_len=2, report="exact_k", k=2)
    return items_in_candidates(candidates(l2))


# ------------------------------------------------------------------ all levels

TYPE_117 = _all_itemsets_sql(TYPE, 117, 1000)


@register("apriori_all", TYPE_117)
def apriori_all_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(117, 1000)))


@register("apriori_exact_3", f"SELECT * FROM ({TYPE_117}) WHERE k = 3")
def apriori_exact_3_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(117, 1000),
                            report="exact_k", k=3))


@register("apriori_last_level",
          f"WITH a AS ({TYPE_117}) SELECT * FROM a WHERE k = (SELECT max(k) FROM a)")
def apriori_last_level_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(117, 1000),
                            report="last_level"))


@register("level_file", f"SELECT * FROM ({TYPE_117}) WHERE k = 2")
def level_file_q(spark, d):
    """All levels written by size, one of them read back."""
    path = f"{run_folder(spark)}/levels-{uuid.uuid4().hex}"
    write_itemsets(apriori(C.order_type_rows(spark, d), Fraction(117, 1000)), path, by_level=True)
    return _as_text(read_itemsets(spark, path, k=2))


@register("apriori_from_2", f"SELECT * FROM ({TYPE_117}) WHERE k >= 2")
def apriori_from_2_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(117, 1000),
                            report="from_k", k=2))


@register("apriori_prefix_walk", _all_itemsets_sql(TYPE, 1, 100))
def apriori_prefix_walk_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(1, 100), strategy="extend"))


@register("apriori_brands", _all_itemsets_sql(BRAND, 3, 1000))
def apriori_brands_q(spark, d):
    return _as_text(apriori(C.order_brand_rows(spark, d), Fraction(3, 1000)))


@register("eclat_all", TYPE_117)
def eclat_all_q(spark, d):
    return _as_text(eclat(C.order_type_rows(spark, d), Fraction(117, 1000)))


@register("fpgrowth_itemsets", _all_itemsets_sql(BRAND, 2, 100))
def fpgrowth_itemsets_q(spark, d):
    return _as_text(fpgrowth(C.order_brand_rows(spark, d), Fraction(2, 100)))


@register("daily_event_sets", _all_itemsets_sql(
    "SELECT DISTINCT {'user_id': user_id, 'day': CAST(ts AS DATE)} AS tid, event_type AS item FROM events",
    5, 100))
def daily_event_sets_q(spark, d):
    return _as_text(apriori(C.daily_event_rows(spark, d), Fraction(5, 100)))


# ------------------------------------------------------------------ rules

@register("association_rules", f"""
WITH RECURSIVE b AS ({TYPE}), {N},
s(tid, items, last) AS (
  SELECT tid, [item], item FROM b
  UNION ALL
  SELECT s.tid, list_append(s.items, b.item), b.item FROM s JOIN b ON s.tid = b.tid AND b.item > s.last),
f AS (SELECT items, count(*) AS support FROM s GROUP BY items HAVING count(*) * 100 >= (SELECT n FROM n)),
r AS (SELECT f.items, f.support, unnest(f.items) AS consequent FROM f WHERE len(f.items) >= 2)
SELECT array_to_string(list_filter(r.items, lambda x: x <> r.consequent), '|') AS antecedent, r.consequent,
       r.support, a.support AS antecedent_support, (r.support * 1000000) // a.support AS confidence_ppm
FROM r JOIN f a ON a.items = list_filter(r.items, lambda x: x <> r.consequent)
WHERE r.support * 1000 >= 488 * a.support""")
def association_rules_q(spark, d):
    sets = apriori(C.order_type_rows(spark, d), Fraction(1, 100))
    rules = association_rules(sets, Fraction(488, 1000))
    ppm = F.call_function("div", F.col("support") * F.lit(1_000_000), F.col("antecedent_support"))
    return rules.select(itemset_text("antecedent").alias("antecedent"), "consequent", "support",
                        "antecedent_support", ppm.cast("bigint").alias("confidence_ppm"))


# ------------------------------------------------------------------ ordered

ORDERED_TYPES = """
s AS (SELECT l_orderkey AS tid, p_type AS item,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r
      FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT count(DISTINCT tid) AS n FROM s)"""


@register("ordered_pairs", f"""
WITH {ORDERED_TYPES}
SELECT a.item AS item1, b.item AS item2, count(DISTINCT a.tid) AS support
FROM s a JOIN s b ON a.tid = b.tid AND a.r < b.r GROUP BY 1, 2
HAVING count(DISTINCT a.tid) * 10 >= (SELECT n FROM n)""")
def ordered_pairs_q(spark, d):
    rows = C.order_type_rows(spark, d, ("l_linenumber", "l_partkey"))
    res = ordered_patterns(rows, Fraction(1, 10), order=("l_linenumber", "l_partkey"),
                           report="exact_k", k=2)
    return res.select(F.col("pattern")[0].alias("item1"), F.col("pattern")[1].alias("item2"),
                      "support")


@register("ordered_triples", f"""
WITH {ORDERED_TYPES}
SELECT a.item AS item1, b.item AS item2, c.item AS item3, count(DISTINCT a.tid) AS support
FROM s a JOIN s b ON a.tid = b.tid AND a.r < b.r JOIN s c ON c.tid = a.tid AND b.r < c.r GROUP BY 1, 2, 3
HAVING count(DISTINCT a.tid) * 100 >= 3 * (SELECT n FROM n)""")
def ordered_triples_q(spark, d):
    rows = C.order_type_rows(spark, d, ("l_linenumber", "l_partkey"))
    res = ordered_patterns(rows, Fraction(3, 100), order=("l_linenumber", "l_partkey"),
                           report="exact_k", k=3)
    return res.select(*[F.col("pattern")[i].alias(f"item{i + 1}") for i in range(3)], "support")


@register("daily_event_sequences", """
WITH s AS (SELECT {'user_id': user_id, 'day': CAST(ts AS DATE)} AS tid, event_type AS item,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS r FROM events),
n AS (SELECT count(DISTINCT tid) AS n FROM s)
SELECT a.item AS item1, b.item AS item2, count(DISTINCT a.tid) AS support
FROM s a JOIN s b ON a.tid = b.tid AND a.r < b.r GROUP BY 1, 2
HAVING count(DISTINCT a.tid) * 100 >= 5 * (SELECT n FROM n)""")
def daily_event_sequences_q(spark, d):
    rows = C.daily_event_rows(spark, d)
    res = ordered_patterns(rows, Fraction(5, 100), order=("ts", "event_id"),
                           report="exact_k", k=2)
    return res.select(F.col("pattern")[0].alias("item1"), F.col("pattern")[1].alias("item2"),
                      "support")


# ------------------------------------------------------------------ documents

@register("doc_terms_pairs", """
WITH b AS (SELECT DISTINCT tid, item FROM (
             SELECT doc_id AS tid, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS item
             FROM documents WHERE text IS NOT NULL) WHERE item <> ''),
n AS (SELECT count(DISTINCT tid) AS n FROM b),
f AS (SELECT item FROM b GROUP BY item HAVING count(*) * 5 >= (SELECT n FROM n)),
fb AS (SELECT * FROM b SEMI JOIN f USING (item))
SELECT x.item AS item1, y.item AS item2, count(*) AS support
FROM fb x JOIN fb y ON x.tid = y.tid AND x.item < y.item
GROUP BY 1, 2 HAVING count(*) * 5 >= (SELECT n FROM n)""")
def doc_terms_pairs_q(spark, d):
    return pair_support(C.document_word_rows(spark, d, distinct=True), Fraction(1, 5))


# ------------------------------------------------------------------ more report modes and options

@register("eclat_exact_3", f"SELECT * FROM ({TYPE_117}) WHERE k = 3")
def eclat_exact_3_q(spark, d):
    return _as_text(eclat(C.order_type_rows(spark, d), Fraction(117, 1000), report="exact_k", k=3))


@register("r_apriori_no_discard", f"""
WITH b AS ({BRAND}), {N}
SELECT x.item AS item1, y.item AS item2, z.item AS item3, count(*) AS support
FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item JOIN b z ON z.tid = x.tid AND y.item < z.item
GROUP BY 1, 2, 3 HAVING count(*) * 1000 >= 3 * (SELECT n FROM n)""")
def r_apriori_no_discard_q(spark, d):
    res = r_apriori(C.order_brand_rows(spark, d), Fraction(3, 1000), discard=False,
                    report="exact_k", k=3)
    return _as_columns(res, 3)


@register("apriori_min_basket_3", _all_itemsets_sql(
    f"SELECT * FROM ({TYPE}) WHERE tid IN (SELECT tid FROM ({TYPE}) GROUP BY tid HAVING count(*) >= 3)",
    5, 100))
def apriori_min_basket_3_q(spark, d):
    return _as_text(apriori(C.order_type_rows(spark, d), Fraction(5, 100), min_basket_size=3))


@register("doc_word_support", """
WITH b AS (SELECT DISTINCT tid, item FROM (
             SELECT doc_id AS tid, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS item
             FROM documents WHERE text IS NOT NULL) WHERE item <> ''),
n AS (SELECT count(DISTINCT tid) AS n FROM b)
SELECT item, count(*) AS support FROM b GROUP BY item HAVING count(*) * 5 >= (SELECT n FROM n)""")
def doc_word_support_q(spark, d):
    res = apriori(C.document_word_rows(spark, d, distinct=True), Fraction(1, 5), max_len=1)
    return res.select(F.col("itemset")[0].alias("item"), "support")


# ------------------------------------------------------------------ files and pipelines
#
# Each writes the tables' rows as files of the source's format under the run
# folder and runs the source or pipeline on them.

def _file(spark, df: DataFrame, sep: str) -> str:
    path = f"{run_folder(spark)}/file-{uuid.uuid4().hex}"
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def _retail_file(spark, d) -> str:
    li = C.order_type_rows(spark, d, ("l_linenumber", "l_shipdate"))
    time = F.concat(F.date_format("l_shipdate", "MM/dd/yyyy"), F.lit(" 10:00:00"))
    # every seventh line has a time that is none
    time = F.when(F.col("l_linenumber") == 7, F.lit("unknown")).otherwise(time)
    cols = {"InvoiceNo": F.col("tid"), "StockCode": F.col("item"), "Description": F.lit("a, b"),
            "Quantity": F.lit(1), "InvoiceDate": time, "UnitPrice": F.lit("1.0"),
            "CustomerID": F.lit(None).cast("string"), "Country": F.lit("x")}
    return _file(spark, li.select(*[c.alias(n) for n, c in cols.items()]), ",")


@register("basket_file", """
WITH b AS (SELECT DISTINCT l_orderkey AS tid, l_suppkey AS item FROM lineitem), n AS (SELECT count(DISTINCT tid) AS n FROM b)
SELECT item, count(*) AS support FROM b GROUP BY item HAVING count(*) * 100 >= 3 * (SELECT n FROM n)""")
def basket_file_q(spark, d):
    path = f"{run_folder(spark)}/file-{uuid.uuid4().hex}"
    write_baskets_text(to_baskets(C.order_column_rows(spark, d, "l_suppkey")), path)
    res = apriori(read_rows(spark, path, "bigint"), Fraction(3, 100), max_len=1,
                  n_baskets=count_lines(spark, path))
    return res.select(F.col("itemset")[0].alias("item"), "support")


@register("csv_baskets", _pairs_sql(BRAND, 2, 100))
def csv_baskets_q(spark, d):
    path = _file(spark, C.order_brand_rows(spark, d), ",")
    return _as_columns(csv_basket_analysis(spark, path, Fraction(2, 100), "tid", "item", max_len=2,
                                           report="exact_k", k=2), 2)


@register("pos_baskets", """
WITH b AS (SELECT DISTINCT l_orderkey AS tid, l_suppkey::VARCHAR AS item FROM lineitem WHERE l_linenumber <> 1),
n AS (SELECT count(DISTINCT tid) AS n FROM b)
SELECT item, count(*) AS support FROM b GROUP BY item HAVING count(*) * 100 >= 3 * (SELECT n FROM n)""")
def pos_baskets_q(spark, d):
    li = C.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    # first lines carry a code that is not numeric and is dropped (PRJ-13)
    code = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("X"), "l_suppkey")) \
        .otherwise(F.col("l_suppkey").cast("string"))
    at = {POS_COLUMNS["RPA_TNR"]: F.col("l_orderkey").cast("string"),
          POS_COLUMNS["RPA_BTS"]: F.lit("10:00"), POS_COLUMNS["EANUPC"]: code}
    wide = li.select(*[at.get(i, F.lit(None).cast("string")).alias(f"c{i}") for i in range(POS_N_COLUMNS)])
    res = pos_basket_analysis(spark, _file(spark, wide, POS_SEP), Fraction(3, 100), max_len=1,
                              numeric_only=True)
    return res.select(F.col("itemset")[0].alias("item"), "support")


@register("retail_sets", TYPE_117)
def retail_sets_q(spark, d):
    coded = f"{run_folder(spark)}/file-{uuid.uuid4().hex}"
    return _as_text(retail_basket_analysis(spark, _retail_file(spark, d), Fraction(117, 1000),
                                           encoded_out=coded))


@register("coded_baskets", f"""
WITH b AS ({TYPE}), s AS (SELECT item, count(*) AS support FROM b GROUP BY item),
dct AS (SELECT item, row_number() OVER (ORDER BY support, item) AS id FROM s)
SELECT array_to_string(list_sort(list(id)), '|') AS itemset, count(*) OVER () AS n
FROM b JOIN dct USING (item) GROUP BY tid""")
def coded_baskets_q(spark, d):
    # the integer-coded baskets of the retail job (SNK-2), read back
    coded = f"{run_folder(spark)}/file-{uuid.uuid4().hex}"
    retail_basket_analysis(spark, _retail_file(spark, d), Fraction(117, 1000), encoded_out=coded, max_len=1)
    baskets = read_baskets(spark, coded, sep=r"\s*,\s*")
    return baskets.select(F.concat_ws("|", F.array_sort("items").cast("array<string>")).alias("itemset"),
                          F.lit(count_lines(spark, coded)).cast("bigint").alias("n"))


@register("retail_sequences", f"""
WITH r AS (SELECT l_orderkey AS tid, p_type AS item, l_shipdate AS ts FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_linenumber <> 7),
s AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY ts, item) AS r FROM r),
n AS (SELECT count(DISTINCT tid) AS n FROM s)
SELECT a.item AS item1, b.item AS item2, count(DISTINCT a.tid) AS support
FROM s a JOIN s b ON a.tid = b.tid AND a.r < b.r GROUP BY 1, 2
HAVING count(DISTINCT a.tid) * 10 >= (SELECT n FROM n)""")
def retail_sequences_q(spark, d):
    res = retail_ordered_analysis(spark, _retail_file(spark, d), Fraction(1, 10), report="exact_k", k=2)
    return res.select(F.col("pattern")[0].alias("item1"), F.col("pattern")[1].alias("item2"), "support")


@register("retail_prepared", f"""
WITH r AS (SELECT l_orderkey AS tid, p_type AS item, min(l_shipdate) AS ts FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_linenumber <> 7 GROUP BY 1, 2)
SELECT tid::VARCHAR AS tid, string_agg(item, ' ' ORDER BY ts, item) AS basket FROM r GROUP BY tid""")
def retail_prepared_q(spark, d):
    baskets = retail_prepare(spark, _retail_file(spark, d), time_ordered=True)
    return baskets.select("tid", F.concat_ws(" ", "items").alias("basket"))


@register("eclat_from_2", f"SELECT * FROM ({TYPE_117}) WHERE k >= 2")
def eclat_from_2_q(spark, d):
    return _as_text(eclat(C.order_type_rows(spark, d), Fraction(117, 1000), report="from_k", k=2))


@register("fpgrowth_deep", _all_itemsets_sql(TYPE, 1, 100))
def fpgrowth_deep_q(spark, d):
    return _as_text(fpgrowth(C.order_type_rows(spark, d), Fraction(1, 100)))
