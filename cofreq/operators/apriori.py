"""Level-wise Apriori (MINE-1, MINE-2, MINE-7) and R-Apriori (MINE-8).

The frequent itemsets form a prefix tree kept as tables: a node is one itemset,
numbered when its level is written, and its table row names the node of its
prefix and the code of its last item.  Items get codes in their natural order.

State between levels is an *occurrence table* ``(tid, parent, last)``: the
itemset that adds item ``last`` to node ``parent`` occurs in basket ``tid``,
three numbers a row whatever the itemset's size.  Two occurrences of one basket
that share a parent make a (k+1)-candidate occurrence (JN-5): a skew-safe
self-join on ``(tid, parent)`` with ``last_a < last_b``.  Counting is a hash
aggregate on ``(parent, last_a, last_b)``; the frequent ones are written as the
next level's nodes with their items, and the next occurrence table is the
candidate occurrences joined with that level, so baskets shrink to what can
still grow (PRJ-6).  Candidates and levels are written under the checkpoint
folder, and counted while they are written: lineage stays one level deep, a lost
executor only re-runs the current level, and with a ``resume`` folder a lost
driver does too.

Result contract (all miners): ``itemset ARRAY<item>`` (sorted), ``k INT``,
``support BIGINT``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import empty_array
from ..session import Store, release
from .groupjoin import DEFAULT_MAX_GROUP, group_join, pairs_within
from .listed import join_listed
from .support import (basket_stats, frequent, frequent_rows, item_support, pair_occurrences, prepare,
                      triple_support)

REPORTS = ("all", "exact_k", "last_level", "from_k")


def level_result(levels: list[DataFrame]) -> list[DataFrame]:
    """Level tables ``(prefix, last, support)`` -> result contract."""
    out = []
    for lv in levels:
        itemset = F.concat(F.col("prefix"), F.array(F.col("last")))
        out.append(lv.select(itemset.alias("itemset"),
                             F.size(itemset).cast("int").alias("k"),
                             F.col("support").cast("bigint").alias("support")))
    return out


def select_report(levels: list[DataFrame], report: str, k: int | None,
                  template: DataFrame) -> DataFrame:
    """Pick the reported levels (SNK-3).

    ``all`` every level; ``exact_k`` level ``k`` only (empty if the mining
    stopped earlier); ``last_level`` the deepest non-empty level; ``from_k``
    every level from ``k`` on.  ``levels[i]`` holds itemsets of size i + 1.
    """
    if report not in REPORTS:
        raise ValueError(f"report must be one of {REPORTS}")
    if report in ("exact_k", "from_k") and (k is None or k < 1):
        raise ValueError(f"report={report!r} needs k >= 1")
    if report == "all":
        chosen = levels
    elif report == "exact_k":
        chosen = levels[k - 1:k]
    elif report == "from_k":
        chosen = levels[k - 1:]
    else:
        chosen = levels[-1:]
    if not chosen:
        return template.limit(0)
    out = chosen[0]
    for lv in chosen[1:]:
        out = out.unionByName(lv)
    return out


def _stop_level(max_len: int | None, report: str, k: int | None) -> int | None:
    stop = max_len
    if report == "exact_k" and k is not None:
        stop = k if stop is None else min(stop, k)
    return stop


def apriori(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
            max_len: int | None = None, report: str = "all", k: int | None = None,
            count_mode: str = "presence", strategy: str = "pairs",
            max_group: int = DEFAULT_MAX_GROUP, min_basket_size: int | None = None,
            num_partitions: int | None = None, n_baskets: int | None = None,
            already_distinct: bool = False, resume: str | None = None) -> DataFrame:
    """Frequent itemsets of long rows ``(tid, item)``.

    ``min_support``: absolute count (int) or share of baskets (float /
    Fraction / (num, den)).  ``max_len`` caps the itemset size.  ``report``
    see :func:`select_report`.  ``count_mode='occurrence'`` counts repeated
    items for single items only (AGG-2).  ``strategy='pairs'`` joins
    occurrences that share a prefix (JN-5); ``'extend'`` extends every
    frequent set found in a basket by each later frequent item of that basket
    (CG-5, the prefix-tree walk); both give the same itemsets.
    ``min_basket_size``, ``num_partitions``, ``n_baskets`` and
    ``already_distinct`` see :func:`support.prepare`.

    ``resume`` is a folder that driver and executors share.  A run keeps its
    tables there, and a later run of the same rows and parameters starts after
    the last table that was finished (``max_len``, ``report`` and ``k`` may
    differ); other parameters are refused.
    """
    if strategy not in ("pairs", "extend"):
        raise ValueError("strategy must be 'pairs' or 'extend'")
    store = Store(rows.sparkSession, resume, dict(
        min_support=min_support, tid=tid, item=item, count_mode=count_mode, strategy=strategy,
        min_basket_size=min_basket_size, n_baskets=n_baskets))
    prep = prepare(rows, min_support, tid, item, min_basket_size=min_basket_size,
                   num_partitions=num_partitions, n_baskets=n_baskets,
                   already_distinct=already_distinct, store=store)
    raw = rows.select(tid, item)
    if count_mode == "occurrence" and min_basket_size:
        raw = raw.join(prep.rows.select(tid).distinct(), tid, "left_semi")
    m = prep.threshold
    stop = _stop_level(max_len, report, k)

    counts = (item_support(raw, tid, item, mode="occurrence") if count_mode == "occurrence"
              else item_support(prep.rows, tid, item, mode=count_mode, already_distinct=True))
    # ids of a sorted table rise with the order, so codes compare as items do
    coded = frequent(counts, m).orderBy(item).withColumn("code", F.monotonically_increasing_id())
    dictionary, size = store.write(coded, "items")
    items, _ = store.write(
        join_listed(prep.rows, dictionary.select(item, "code"), item, "inner")
        .select(tid, F.col("code").alias("last")), "coded-rows", num_partitions, tid)
    widest = prep.max_basket
    if widest > max_group:
        # pruning may have made every basket small; measure only when it matters
        widest = store.value("widest", lambda: basket_stats(items, tid).max_basket)

    root = F.lit(0).cast("bigint")
    levels = [dictionary.select(F.array(item).alias("itemset"), "support")]
    nodes = dictionary.select(root.alias("parent"), F.col("code").alias("last"),
                              F.col("code").alias("node"), F.array(item).alias("itemset"))
    names = dictionary.select(F.col("code").alias("last_b"), F.col(item).alias("_name"))
    occ = items.select(tid, root.alias("parent"), "last")
    made, level = None, 1
    while size > 1 and (stop is None or level < stop):
        # a basket of L items holds at most C(L, level) occurrences of a level;
        # one parent of a basket at most L
        held = widest if strategy == "pairs" else max(widest, math.comb(widest, level))
        check = held > max_group
        if strategy == "pairs":
            cand = pairs_within(occ, [tid, "parent"], "last", max_group=max_group,
                                check_hot=check)
            if level >= 2:
                # the two last items must be a frequent pair themselves (CG-6),
                # so most candidates that fail are never counted
                cand = join_listed(cand, pair_keys, ["last_a", "last_b"], bound=n_pairs)
        else:
            cand = group_join(occ, items.select(tid, F.col("last").alias("next")), [tid],
                              left_spread=["parent", "last"], right_spread=["next"],
                              condition=F.col("next") > F.col("last"), max_group=max_group,
                              check_hot=check)
            cand = cand.select(tid, "parent", F.col("last").alias("last_a"),
                               F.col("next").alias("last_b"))
        key = ["parent", "last_a", "last_b"]
        # joined once: the level is counted from the file, without the baskets,
        # and the next occurrences are the file's rows that match the level
        cand, _ = store.write(cand, f"candidates-{level + 1}")
        release(made)
        made = cand
        found = frequent(cand.groupBy(*key).agg(F.count(F.lit(1)).alias("support")), m)
        grown = (found.join(nodes.withColumnRenamed("last", "last_a")
                            .withColumnRenamed("node", "prefix"), ["parent", "last_a"])
                 .join(names, "last_b")
                 .select(*key, "prefix", F.monotonically_increasing_id().alias("node"),
                         F.concat("itemset", F.array("_name")).alias("itemset"), "support"))
        grown, size = store.write(grown, f"level-{level + 1}")
        if size == 0:
            break
        levels.append(grown.select("itemset", "support"))
        level += 1
        nodes = grown.select(F.col("prefix").alias("parent"), F.col("last_b").alias("last"),
                             "node", "itemset")
        if level == 2 and strategy == "pairs":
            pair_keys, n_pairs = grown.select("last_a", "last_b"), size
        occ = join_listed(cand, grown.select(*key, "prefix"), key, "inner", bound=size).select(
            tid, F.col("prefix").alias("parent"), F.col("last_b").alias("last"))
    release(made, items)
    if not already_distinct:
        release(prep.rows)
    out = [lv.select("itemset", F.size("itemset").cast("int").alias("k"),
                     F.col("support").cast("bigint").alias("support")) for lv in levels]
    return select_report(out, report, k, out[0])


def r_apriori(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
              discard: bool = True, max_len: int = 3, report: str = "all",
              k: int | None = None, max_group: int = DEFAULT_MAX_GROUP,
              n_baskets: int | None = None) -> DataFrame:
    """R-Apriori: three fixed passes L1, L2, L3 (MINE-8); larger sets are
    :func:`apriori`'s, and asking for them here raises.

    Pass 2 builds pairs straight from the baskets instead of joining
    candidates; with ``discard`` the baskets are cut to frequent items first.
    Pass 3 joins frequent-pair occurrences on their first item (CG-3).
    """
    if max_len > 3 or (k or 0) > 3:
        raise ValueError("r_apriori has three passes: max_len and k go up to 3; use apriori")
    store = Store(rows.sparkSession)
    prep = prepare(rows, min_support, tid, item, n_baskets=n_baskets, store=store)
    m = prep.threshold
    item_type = prep.rows.schema[item].dataType
    l1, kept, widest = frequent_rows(prep, tid, item, max_group=max_group)
    check = widest > max_group
    levels = [l1.select(empty_array(item_type).alias("prefix"), F.col(item).alias("last"),
                        "support")]
    if max_len >= 2:
        pair_rows = kept if discard else prep.rows
        if not discard:
            check = prep.max_basket > max_group
        occ, _ = store.write(pair_occurrences(pair_rows, tid, item, max_group, check), "r-pairs")
        l2, size = store.write(frequent(occ.groupBy("item1", "item2")
                                        .agg(F.count(F.lit(1)).alias("support")), m), "r-level-2")
        if size:
            levels.append(l2.select(F.array("item1").alias("prefix"),
                                    F.col("item2").alias("last"), "support"))
        if max_len >= 3 and len(levels) == 2:
            l3, size = store.write(triple_support(pair_rows, l2, m, tid, item, max_group, check,
                                                  occurrences=occ), "r-level-3")
            if size:
                levels.append(l3.select(F.array("item1", "item2").alias("prefix"),
                                        F.col("item3").alias("last"), "support"))
        release(occ)
    release(kept, prep.rows)
    out = level_result(levels)
    return select_report(out, report, k, out[0])
