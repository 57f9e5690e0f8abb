"""Explicit candidates: generation, subset pruning, containment counting.

``candidates`` builds (k+1)-candidates from a level of frequent k-itemsets
by joining sets that share their first k-1 items (CG-4) -- an equi-join on
the prefix instead of a cartesian product, so no duplicate candidates -- and
drops candidates with an infrequent k-subset (CG-6).  ``count_containment``
counts the baskets containing each candidate (JN-1) with equi-joins on the
item: a basket contains a k-candidate when k of its rows match.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from .groupjoin import DEFAULT_MAX_GROUP, group_join, pairs_within
from .support import basket_stats, distinct_rows


def candidates(level: DataFrame, itemset: str = "itemset", prune: bool = True,
               max_group: int = DEFAULT_MAX_GROUP) -> DataFrame:
    """``(itemset)`` of size k+1 from sorted k-itemsets in ``level``, all of
    one size of at least 2.  Pairs of single items have no prefix to join on
    and would be all pairs: :func:`support.pair_occurrences` builds those that
    occur."""
    sizes = _sizes(level, itemset)
    if len(sizes) > 1 or sizes == [1]:
        raise ValueError(f"candidates needs itemsets of one size of at least 2, not {sizes}")
    split = level.select(F.slice(itemset, 1, F.size(itemset) - 1).alias("prefix"),
                         F.element_at(itemset, -1).alias("last"))
    pairs = pairs_within(split, ["prefix"], "last", max_group=max_group)
    cand = pairs.select(F.concat("prefix", F.array("last_a", "last_b")).alias(itemset))
    if not prune:
        return cand
    # The two generators are frequent by construction; test the subsets that
    # drop one of the first k-1 items.
    if not sizes:
        return cand
    known = broadcast_if_small(level.select(F.col(itemset).alias("_subset")))
    for drop in range(sizes[0] - 1):
        cand = (cand.withColumn("_subset", _without_position(itemset, drop))
                .join(known, "_subset", "left_semi").drop("_subset"))
    return cand


def _sizes(sets: DataFrame, itemset: str) -> list[int]:
    """The different sizes of itemsets, ascending."""
    return sorted(r[0] for r in sets.select(F.size(itemset)).distinct().collect())


def _without_position(itemset: str, pos: int):
    return F.filter(itemset, lambda _x, j: j != F.lit(pos))


def count_containment(rows: DataFrame, cands: DataFrame, tid: str = "tid", item: str = "item",
                      itemset: str = "itemset", keep_zero: bool = True,
                      max_group: int = DEFAULT_MAX_GROUP,
                      already_distinct: bool = False) -> DataFrame:
    """``(itemset, support)``: baskets holding every item of a candidate (JN-1).

    A prefix walk over the baskets restricted to candidate prefixes: start
    with basket rows whose item begins some candidate, extend each partial
    match by a later item of the same basket (skew-safe join on ``tid``) and
    keep it only while it is still a prefix of some candidate.  Work grows
    with the matches that exist, not with candidates x baskets.  Candidates of
    several sizes are counted size by size.
    """
    if not already_distinct:
        rows = distinct_rows(rows, tid, item)
    cset = materialize(cands.select(F.col(itemset).alias("_cand")), "candidates")
    n_cand = cset.count()
    if n_cand == 0:
        return cset.select(F.col("_cand").alias(itemset), F.lit(0).cast("bigint").alias("support"))
    sizes = _sizes(cset, "_cand")
    if len(sizes) > 1:
        if not already_distinct:
            rows = materialize(rows, "rows")
        out = None
        for size in sizes:
            one = count_containment(rows, cset.where(F.size("_cand") == size), tid, item, "_cand",
                                    keep_zero, max_group, already_distinct=True)
            out = one if out is None else out.unionByName(one)
        return out.withColumnRenamed("_cand", itemset)
    k = sizes[0]
    # every helper table below has at most n_cand * k rows
    bound = n_cand * k
    firsts = broadcast_if_small(cset.select(F.col("_cand")[0].alias(item)).distinct(), bound=bound)
    used = broadcast_if_small(items_in_candidates(cset, "_cand", item), bound=bound)
    rows = materialize(rows.join(used, item, "left_semi"), "candidate-rows")
    longest = basket_stats(rows, tid).max_basket
    part = rows.join(firsts, item, "left_semi").select(tid, F.array(item).alias("_pre"),
                                                       F.col(item).alias("_last"))
    nxt = rows.select(tid, F.col(item).alias("_next"))
    for j in range(2, k + 1):
        # a basket of L rows holds at most C(L, j - 1) partial matches
        check = max(longest, math.comb(longest, j - 1)) > max_group
        ext = group_join(part, nxt, [tid], left_spread=["_pre"], right_spread=["_next"],
                         condition=F.col("_next") > F.col("_last"), max_group=max_group,
                         check_hot=check)
        ext = ext.select(tid, F.concat("_pre", F.array("_next")).alias("_pre"),
                         F.col("_next").alias("_last"))
        prefixes = broadcast_if_small(cset.select(F.slice("_cand", 1, j).alias("_pre")).distinct(),
                                      bound=n_cand)
        part = ext.join(prefixes, "_pre", "left_semi")
        if j < k:
            part = materialize(part, f"containment-{j}")
    counts = part.groupBy(F.col("_pre").alias("_cand")).agg(F.count(F.lit(1)).alias("support"))
    if keep_zero:
        out = cset.join(counts, "_cand", "left").fillna(0, ["support"])
    else:
        out = counts
    return out.select(F.col("_cand").alias(itemset), F.col("support").cast("bigint"))


def items_in_candidates(cands: DataFrame, itemset: str = "itemset",
                        item: str = "item") -> DataFrame:
    """Distinct items still used by some candidate (AGG-12)."""
    return cands.select(F.explode(itemset).alias(item)).distinct()
