"""Retail pipelines, delimited sources and basket sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from cofreq.plans.pipelines import (basket_analysis, retail_basket_analysis,
                                    retail_ordered_analysis, retail_prepare, retail_rows)
from cofreq.sources import read_baskets, read_delimited
from cofreq.sources.sinks import write_baskets_text, write_itemsets

from conftest import fixture_path, level_sizes

RETAIL = fixture_path("retail99.csv")


def _sets_of_file(path):
    with open(path) as fh:
        return sorted(tuple(sorted(set(line.split()))) for line in fh if line.strip())


def test_retail_ms3_levels_and_items(spark):
    res = retail_basket_analysis(spark, RETAIL, 3)
    assert level_sizes(res) == [9, 22, 35, 35, 21, 7, 1]
    singles = {r["itemset"][0] for r in res.where("k = 1").collect()}
    assert singles == {"21730", "22632", "22633", "22752", "71053", "84029E", "84029G",
                       "84406B", "85123A"}
    assert {r["support"] for r in res.collect()} == {3}


def test_retail_ms3_contains_the_six_published_triples(spark):
    triples = {frozenset(r["itemset"]) for r in
               retail_basket_analysis(spark, RETAIL, 3, report="exact_k", k=3).collect()}
    published = [["21730", "71053", "22752"], ["21730", "85123A", "84029E"],
                 ["21730", "85123A", "84029G"], ["85123A", "84029E", "84029G"],
                 ["21730", "84029E", "84029G"], ["21730", "85123A", "22752"]]
    assert all(frozenset(t) in triples for t in published)


def test_retail_ms2_first_levels(spark):
    res = retail_basket_analysis(spark, RETAIL, 2, max_len=3)
    assert level_sizes(res) == [18, 121, 560]


def test_prepared_baskets_equal_saved_output(spark):
    out = tempfile.mkdtemp(prefix="cofreq-test-")
    path = os.path.join(out, "baskets")
    baskets = retail_prepare(spark, RETAIL, out=path)
    assert baskets.count() == 14
    got = sorted(tuple(sorted(set(r["value"].split()))) for r in spark.read.text(path).collect())
    assert got == _sets_of_file(fixture_path("baskets_out.txt"))
    numeric = retail_prepare(spark, RETAIL, numeric_only=True)
    got = sorted(tuple(sorted(set(r["items"]))) for r in numeric.collect())
    assert got == _sets_of_file(fixture_path("baskets_numeric_out.txt"))


def test_encoded_baskets_sink(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="cofreq-test-"), "encoded")
    retail_basket_analysis(spark, RETAIL, 3, encoded_out=out, max_len=1).count()
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert len(lines) == 14
    assert all(all(t.isdigit() for t in line.split(", ")) for line in lines)


def test_ordered_retail_patterns_are_order_aware(spark):
    res = retail_ordered_analysis(spark, RETAIL, 3, max_len=2)
    pats = {tuple(r["pattern"]) for r in res.where("k = 2").collect()}
    sets = {frozenset(r["itemset"]) for r in
            retail_basket_analysis(spark, RETAIL, 3, max_len=2).where("k = 2").collect()}
    # every ordered pair is a frequent set; a set may appear in one or both orders
    assert {frozenset(p) for p in pats} <= sets


def test_retail_rows_pick_columns_by_position(spark):
    df = retail_rows(spark, RETAIL)
    assert df.columns == ["InvoiceNo", "StockCode", "InvoiceDate"]
    assert df.count() == 99


def test_pos_file_positions(spark):
    d = tempfile.mkdtemp(prefix="cofreq-test-")
    path = os.path.join(d, "pos.csv")
    header = "|".join(f"C{i}" for i in range(75))
    lines = [header]
    for tid, store, art in [("t1", "s", "a"), ("t1", "s", "b"), ("t2", "s", "a"),
                            ("t2", "s", "b"), ("t3", "s", "a"), ("", "s", "b")]:
        cells = [""] * 75
        cells[0], cells[13], cells[35] = tid, store, art
        lines.append("|".join(cells))
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    from cofreq.plans.pipelines import pos_basket_analysis
    got = {tuple(r["itemset"]): r["support"] for r in pos_basket_analysis(spark, path, 2).collect()}
    assert got == {("a",): 3, ("b",): 2, ("a", "b"): 2}


def test_text_round_trip_and_itemset_sink(spark):
    d = tempfile.mkdtemp(prefix="cofreq-test-")
    b = read_baskets(spark, fixture_path("simple.txt"))
    write_baskets_text(b, os.path.join(d, "b"))
    again = read_baskets(spark, os.path.join(d, "b"))
    assert sorted(map(tuple, (r["items"] for r in b.collect()))) == \
        sorted(map(tuple, (r["items"] for r in again.collect())))
    from cofreq.operators.apriori import apriori
    from cofreq.sources.text import baskets_to_rows
    res = apriori(baskets_to_rows(b), 2)
    write_itemsets(res, os.path.join(d, "p"))
    write_itemsets(res, os.path.join(d, "t"), fmt="text")
    assert spark.read.parquet(os.path.join(d, "p")).count() == 13
    assert "1 2 3: 2" in {r["value"] for r in spark.read.text(os.path.join(d, "t")).collect()}


def test_delimited_by_name_keeps_quoted_commas(spark):
    df = read_delimited(spark, RETAIL, ["InvoiceNo", "Description"])
    assert df.where(F.col("Description").contains(",")).count() >= 0
    assert df.count() == 99


def test_basket_analysis_drops_blank_ids(spark):
    rows = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"),
                                  (" ", "a"), (None, "b"), ("3", ""), ("3", None)],
                                 "tid string, item string")
    got = {tuple(r["itemset"]): r["support"] for r in basket_analysis(rows, 2, tid="tid",
                                                                         item="item").collect()}
    assert got == {("a",): 2, ("b",): 2, ("a", "b"): 2}
