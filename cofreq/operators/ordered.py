"""Order-aware patterns over time-ordered baskets (MINE-10).

A pattern ``[x1, ..., xk]`` is contained in a basket when its items occur
in that order (not necessarily next to each other); ``[a, b]`` and
``[b, a]`` are different patterns and an item may repeat.  Support counts
baskets.

State per level: ``(tid, node, end)`` where ``node`` numbers a frequent
pattern and ``end`` is the position of the earliest embedding's last item;
extending by an item at a later position and taking the minimum keeps it
earliest.  Items have codes and positions are numbers, so every aggregate hashes
fixed-width keys.  The extension is a skew-safe join on ``tid`` with ``position >
end`` (no per-basket arrays).

Every step is dealt to as many partitions as its counted rows need,
so a task's sorts and hash tables hold about ``TASK_ROWS`` rows whatever the
input's size and the session's number of shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Store, materialize, release
from .apriori import select_report
from .fpgrowth import fraction_for_count
from .groupjoin import DEFAULT_MAX_GROUP, group_join
from .listed import join_listed
from .prepare import ordered_baskets
from .support import (basket_stats, distinct_rows, frequent, item_support, keep_items,
                      min_count)

# Rows that a step sorts or hashes in one task, and the most rows that one row
# counts as when it meets several others.
TASK_ROWS, MOST_MET = 1 << 18, 128


def partitions(rows: int, met: float = 1) -> int:
    """Partitions for ``rows`` rows that meet ``met`` others each.  A basket
    stays whole in a partition, or in the blocks of :func:`group_join`."""
    return max(1, math.ceil(rows * min(max(met, 1), MOST_MET) / TASK_ROWS))


def ordered_patterns(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
                     order: Sequence[str] = ("ts",), max_len: int | None = None,
                     report: str = "all", k: int | None = None,
                     max_group: int = DEFAULT_MAX_GROUP,
                     n_baskets: int | None = None) -> DataFrame:
    """``(pattern ARRAY<item>, k INT, support BIGINT)``.

    ``order`` are the columns giving the order inside a basket; rows that
    tie on all of them are ordered arbitrarily but consistently (fixed once
    the events are written).  Rows with a null transaction id or item are
    dropped; ``n_baskets`` see :func:`support.prepare`.
    """
    # A distributed sort by the order: the ids of its rows rise with it, so one
    # number per event compares as the order does.  The transaction cuts ties that
    # would fill a task.  Written once and fixed.
    store = Store(rows.sparkSession)
    columns = list(dict.fromkeys([tid, item, *order]))
    raw, n = store.write(_events(rows, tid, item).select(*columns), "ordered-rows")
    by = [*order, tid]
    ev, n = store.write(raw.repartitionByRange(partitions(n), *by).sortWithinPartitions(*by).select(
        tid, item, F.monotonically_increasing_id().alias("pos")), "ordered-events")
    release(raw)
    whole = ev.repartition(partitions(n), tid)
    stats = basket_stats(whole, tid)  # baskets and the longest sequence, one job
    m = min_count(min_support, stats.n_baskets if n_baskets is None else n_baskets)
    stop = max_len
    if report == "exact_k" and k is not None:
        stop = k if stop is None else min(stop, k)

    counts = item_support(distinct_rows(whole, tid, item), tid, item, already_distinct=True)
    l1, size = store.write(frequent(counts, m).withColumn("node", F.monotonically_increasing_id()),
                           "ordered-level-1")
    levels = [l1.select(F.array(item).alias("pattern"), "support")]
    if size == 0:
        release(ev)
        return _result(levels, report, k)
    coded, n = store.write(join_listed(ev, l1.select(item, "node"), item, "inner")
                           .select(tid, F.col("node").alias("next"), F.col("pos").alias("npos")),
                           "ordered-coded")
    release(ev)
    names = l1.select(F.col("node").alias("next"), F.col(item).alias("_name"))
    nodes = l1.select("node", F.array(item).alias("pattern"))
    # an event of a sequence of length L is followed by L / 2 others
    met = stats.n_cells / max(1, stats.n_rows) / 2
    parts = partitions(n, met)
    occ = (coded.repartition(parts, tid).groupBy(tid, F.col("next").alias("node"))
           .agg(F.min("npos").alias("end")))
    made, level = None, 1
    while stop is None or level < stop:
        # a sequence of length L holds at most C(L, k) distinct k-patterns, so
        # with both sides provably small the hot-group measurement is skipped
        longest = stats.max_basket
        check = longest > max_group or math.comb(longest, level) > max_group
        ext = group_join(occ, coded, [tid], left_spread=["node"], right_spread=["npos"],
                         condition=F.col("npos") > F.col("end"), max_group=max_group,
                         check_hot=check, parts=parts)
        cand = ext.groupBy(tid, "node", "next").agg(F.min("npos").alias("end"))
        # the earliest ends are counted and, where frequent, joined with their level
        cand, n = store.write(cand, f"ordered-ends-{level + 1}")
        found = frequent(cand.groupBy("node", "next").agg(F.count(F.lit(1)).alias("support")), m)
        lv, size = store.write(
            found.join(nodes, "node").join(names, "next")
            .select(F.col("node").alias("parent"), "next", F.monotonically_increasing_id().alias("node"),
                    F.concat("pattern", F.array("_name")).alias("pattern"), "support"),
            f"ordered-level-{level + 1}")
        release(made)
        made = cand
        if size == 0:
            break
        levels.append(lv.select("pattern", "support"))
        level += 1
        nodes = lv.select("node", "pattern")
        keys = lv.select("parent", "next", F.col("node").alias("_node"))
        parts = partitions(n, met)
        occ = (join_listed(cand.withColumnRenamed("node", "parent"), keys, ["parent", "next"], "inner", bound=size)
               .select(tid, F.col("_node").alias("node"), "end"))
    release(made, coded)
    return _result(levels, report, k)


def _events(rows: DataFrame, tid: str, item: str) -> DataFrame:
    return rows.where(F.col(tid).isNotNull() & F.col(item).isNotNull())


def _result(levels: list[DataFrame], report: str, k: int | None) -> DataFrame:
    out = [lv.select("pattern", F.size("pattern").cast("int").alias("k"),
                     F.col("support").cast("bigint").alias("support")) for lv in levels]
    return select_report(out, report, k, out[0])


def prefixspan(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
               order: Sequence[str] = ("ts",), max_len: int | None = None) -> DataFrame:
    """The same patterns through Spark's ``PrefixSpan`` (one item per
    sequence element); needs one array per basket, of its frequent items
    only."""
    ev = materialize(_events(rows, tid, item).select(tid, item, *order), "sequences")
    sets = distinct_rows(ev, tid, item)
    n = basket_stats(sets.select(tid).distinct(), tid).n_baskets
    m = min_count(min_support, n)
    l1 = frequent(item_support(sets, tid, item, already_distinct=True), m)
    ev = keep_items(ev, l1, item)
    if n < m or ev.isEmpty():
        return ev.select(F.array(item).alias("pattern"), F.lit(0).cast("int").alias("k"),
                         F.lit(0).cast("bigint").alias("support")).limit(0)
    seqs = ordered_baskets(ev, tid, item, order, "items")
    # baskets without a frequent item have no sequence and count no more
    n = seqs.count()
    seqs = seqs.select(F.transform("items", lambda x: F.array(x)).alias("sequence"))
    longest = 2 ** 31 - 1 if max_len is None else max_len
    ps = PrefixSpan(minSupport=fraction_for_count(m, n), maxPatternLength=longest,
                    sequenceCol="sequence", maxLocalProjDBSize=32_000_000)
    res = ps.findFrequentSequentialPatterns(seqs).where(F.col("freq") >= m)
    return res.select(F.flatten("sequence").alias("pattern"),
                      F.size(F.flatten("sequence")).cast("int").alias("k"),
                      F.col("freq").cast("bigint").alias("support"))
