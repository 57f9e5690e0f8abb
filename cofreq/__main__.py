"""Command line: mine a basket file and write the itemsets.

    python -m cofreq apriori  PATH MIN_SUPPORT --out DIR [--k K] [--go-on] [--partitions N]
    python -m cofreq eclat    PATH MIN_SUPPORT --out DIR [--k K] [--go-on] [--partitions N]
    python -m cofreq r-apriori PATH MIN_SUPPORT --out DIR [--k 1..3] [--keep-infrequent]
    python -m cofreq fpgrowth PATH MIN_SUPPORT --out DIR [--partitions N]
    python -m cofreq retail   CSV  MIN_SUPPORT --out DIR [--k K] [--ordered]

``MIN_SUPPORT`` is an absolute count (``2``) or a share of all lines
(``0.003``).  Items are 32-bit integers unless ``--items`` says otherwise; a
token that is none stops the job, or is skipped with ``--lenient``.  ``--k`` reports itemsets of exactly that size; with
``--go-on`` mining continues past ``k`` and reports every level from ``k``
on.  Without ``--k`` every level is reported.  Results are written as
``item item ...: support`` lines by the executors; only the count is
printed.
"""

from __future__ import annotations

import argparse
import sys


def _support(text: str):
    return float(text) if any(c in text for c in ".eE") else int(text)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cofreq", description=__doc__.split("\n")[0])
    ap.add_argument("miner", choices=["apriori", "eclat", "r-apriori", "fpgrowth", "retail"])
    ap.add_argument("path")
    ap.add_argument("min_support", type=_support)
    ap.add_argument("--out", required=True)
    ap.add_argument("--k", type=int)
    ap.add_argument("--go-on", action="store_true", help="continue past k (report k and up)")
    ap.add_argument("--partitions", type=int)
    ap.add_argument("--keep-infrequent", action="store_true",
                    help="r-apriori: build pairs without cutting baskets to frequent items")
    ap.add_argument("--ordered", action="store_true", help="retail: time-ordered patterns")
    ap.add_argument("--items", choices=["int", "bigint", "string"], default="int")
    ap.add_argument("--lenient", action="store_true", help="skip tokens that are no numbers")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    if a.miner == "r-apriori" and (a.go_on or (a.k or 0) > 3):
        ap.error("r-apriori has three passes: --k goes up to 3, without --go-on; use apriori")

    from .operators.apriori import apriori, r_apriori
    from .operators.eclat import eclat
    from .operators.fpgrowth import fpgrowth
    from .plans.pipelines import retail_basket_analysis, retail_ordered_analysis
    from .session import build_session
    from .sources import count_lines, read_rows, write_itemsets

    spark = build_session(a.master) if a.master else build_session()
    report = "all" if a.k is None else ("from_k" if a.go_on else "exact_k")
    max_len = None if (a.k is None or a.go_on) else a.k
    if a.miner == "retail":
        if a.ordered:
            res = retail_ordered_analysis(spark, a.path, a.min_support, report=report, k=a.k,
                                          max_len=max_len).withColumnRenamed("pattern", "itemset")
        else:
            res = retail_basket_analysis(spark, a.path, a.min_support, report=report, k=a.k,
                                         max_len=max_len)
    else:
        rows = read_rows(spark, a.path, a.items, lenient=a.lenient)
        n = count_lines(spark, a.path) if isinstance(a.min_support, float) else None
        if a.miner == "apriori":
            res = apriori(rows, a.min_support, report=report, k=a.k, max_len=max_len,
                          num_partitions=a.partitions, n_baskets=n)
        elif a.miner == "eclat":
            res = eclat(rows, a.min_support, report=report, k=a.k, max_len=max_len,
                        num_partitions=a.partitions, n_baskets=n)
        elif a.miner == "r-apriori":
            res = r_apriori(rows, a.min_support, discard=not a.keep_infrequent,
                            report=report, k=a.k, n_baskets=n)
        else:
            res = fpgrowth(rows, a.min_support, num_partitions=a.partitions, max_len=max_len,
                           n_baskets=n)
            if a.k is not None:
                res = res.where(res.k >= a.k) if a.go_on else res.where(res.k == a.k)
    write_itemsets(res, a.out, fmt="text")
    print(f"{spark.read.text(a.out).count()} itemsets written to {a.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
