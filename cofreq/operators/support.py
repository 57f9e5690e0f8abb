"""Support counting: thresholds, item / pair / triple support, pruning.

Rows are long ``(tid, item)`` rows, never per-basket arrays, so a basket of
any size is spread over many tasks.  Counts are hash aggregates with a
partial (map-side) stage, so a hot item is pre-aggregated in every task
before it is shuffled.
"""

from __future__ import annotations

import dataclasses
import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Store
from .groupjoin import DEFAULT_MAX_GROUP, pairs_within
from .listed import join_listed


# ---------------------------------------------------------------- thresholds

def as_fraction(x) -> Fraction:
    """Exact fraction of a float / str / int / Fraction / (num, den)."""
    if isinstance(x, tuple):
        return Fraction(x[0], x[1])
    if isinstance(x, float):
        return Fraction(repr(x))
    return Fraction(x)


def min_count(min_support, n_baskets: int) -> int:
    """Absolute minimum support.

    An ``int`` is already absolute (PRJ-9).  A float / Fraction / (num, den)
    in ``(0, 1]`` is a share of the baskets (PRJ-10); the smallest count ``c``
    with ``c * den >= num * n`` is returned, so the test is exact integer
    arithmetic.  The result is at least 1.
    """
    if isinstance(min_support, bool):
        raise TypeError("min_support must be a number")
    if isinstance(min_support, int):
        if min_support < 1:
            raise ValueError("absolute min_support must be >= 1")
        return min_support
    share = as_fraction(min_support)
    if not 0 < share <= 1:
        raise ValueError("relative min_support must be in (0, 1]")
    return max(1, math.ceil(share * n_baskets))


@dataclass(frozen=True)
class BasketStats:
    n_baskets: int
    max_basket: int
    n_rows: int = 0
    #: Sum of the baskets' squared sizes: the pairs of rows that meet.
    n_cells: int = 0


def basket_stats(rows: DataFrame, tid: str = "tid") -> BasketStats:
    """Number of baskets, the largest basket and the number of rows, in one
    job (AGG-13)."""
    sizes = rows.groupBy(tid).agg(F.count(F.lit(1)).alias("_size"))
    r = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("m"),
                  F.sum("_size").alias("r"), F.sum(F.col("_size").cast("double") * F.col("_size")).alias("c")).first()
    return BasketStats(int(r["n"] or 0), int(r["m"] or 0), int(r["r"] or 0), int(r["c"] or 0))


@dataclass(frozen=True)
class Prepared:
    """Distinct rows written once, their statistics and the threshold."""
    rows: DataFrame
    n_baskets: int
    max_basket: int
    n_rows: int
    threshold: int

    @property
    def frequent_item_bound(self) -> int:
        """At most ``rows / threshold`` items can be frequent."""
        return self.n_rows // max(self.threshold, 1)


def prepare(rows: DataFrame, min_support, tid: str = "tid", item: str = "item", *,
            min_basket_size: int | None = None,
            num_partitions: int | None = None, n_baskets: int | None = None,
            already_distinct: bool = False, store: Store | None = None) -> Prepared:
    """Write the distinct ``(tid, item)`` rows once (tokenising, dimension
    joins and the dedup run a single time), measure them in one job and
    resolve the threshold.

    ``min_basket_size`` drops baskets with fewer distinct items (PRJ-8, off
    by default; a relative threshold then counts the kept baskets).
    ``num_partitions`` writes the rows in that many buckets by ``tid`` (SRC-6),
    so joins and aggregates of the rows on ``tid`` need no shuffle.  ``n_baskets`` is the number of transactions that
    a relative threshold is a share of, when some of them hold no item and so
    have no row (SRC-1); by default the baskets found in the rows.
    ``already_distinct`` says the rows are sets without nulls, so the dedup is
    skipped, and the write too if they are written rows.  ``store`` keeps the
    rows and their statistics for a run that can be resumed.
    """
    store = store or Store(rows.sparkSession)
    written = getattr(rows, "_cofreq_path", None) if already_distinct and not store.path else None
    rows = rows.select(tid, item) if already_distinct else distinct_rows(rows, tid, item)
    if min_basket_size and min_basket_size > 1:
        rows = keep_baskets(rows, min_basket_size, tid)
    if not written or min_basket_size or num_partitions:
        rows, _ = store.write(rows, "rows", num_partitions, tid)
    st = BasketStats(*store.value("baskets", lambda: dataclasses.astuple(basket_stats(rows, tid))))
    n = st.n_baskets if n_baskets is None else n_baskets
    return Prepared(rows, n, st.max_basket, st.n_rows, min_count(min_support, n))


def frequent_rows(prep: Prepared, tid: str = "tid", item: str = "item",
                  count_mode: str = "presence", raw: DataFrame | None = None,
                  max_group: int = DEFAULT_MAX_GROUP) -> tuple[DataFrame, DataFrame, int]:
    """Frequent items ``(item, support)`` and the rows cut to them (both
    written), and an upper bound of the largest cut basket."""
    from ..session import materialize

    if count_mode == "occurrence" and raw is not None:
        counts = item_support(raw, tid, item, mode="occurrence")
    else:
        counts = item_support(prep.rows, tid, item, mode=count_mode, already_distinct=True)
    every = materialize(counts, "items")
    l1 = frequent(every, prep.threshold)
    widest = prep.max_basket
    if every.where(F.col("support") < F.lit(prep.threshold)).isEmpty():
        return l1, prep.rows, widest  # nothing to cut, nothing to write again
    bound = prep.frequent_item_bound if count_mode == "presence" else None
    kept = materialize(keep_items(prep.rows, l1, item, bound=bound), "frequent-rows")
    if widest > max_group:
        # pruning may have made every basket small; measure only when it matters
        widest = basket_stats(kept, tid).max_basket
    return l1, kept, widest


# ---------------------------------------------------------------- rows

def distinct_rows(rows: DataFrame, tid: str = "tid", item: str = "item") -> DataFrame:
    """Baskets as sets: one row per (tid, item) (PRJ-2); rows with a null
    transaction id or item belong to no basket and go."""
    return (rows.select(tid, item).where(F.col(tid).isNotNull() & F.col(item).isNotNull())
            .dropDuplicates([tid, item]))


def item_support(rows: DataFrame, tid: str = "tid", item: str = "item",
                 mode: str = "presence", already_distinct: bool = False) -> DataFrame:
    """``(item, support)``.

    ``presence`` counts baskets containing the item (AGG-1); ``occurrence``
    counts rows, so an item repeated inside a basket counts more than once
    (AGG-2).  ``already_distinct`` skips the dedup for rows that are sets.
    """
    if mode not in ("presence", "occurrence"):
        raise ValueError("mode must be 'presence' or 'occurrence'")
    if mode == "presence" and not already_distinct:
        rows = distinct_rows(rows, tid, item)
    return (rows.where(F.col(tid).isNotNull() & F.col(item).isNotNull())
            .groupBy(item).agg(F.count(F.lit(1)).alias("support")))


def frequent(counts: DataFrame, threshold: int, col: str = "support") -> DataFrame:
    """Minimum-support filter (PRJ-9): ``support >= threshold``."""
    return counts.where(F.col(col) >= F.lit(int(threshold)))


def keep_items(rows: DataFrame, items: DataFrame, item: str = "item",
               bound: int | None = None, limit: int | None = None) -> DataFrame:
    """Keep rows whose item is in ``items`` (PRJ-5); a semi-join that
    broadcasts the item list only when its size (proven ``bound`` or
    measured) allows, and else drops most other rows before the shuffle (see
    :mod:`listed`)."""
    return join_listed(rows, items.select(item), item, bound=bound, limit=limit)


def keep_baskets(rows: DataFrame, min_items: int, tid: str = "tid") -> DataFrame:
    """Keep baskets with at least ``min_items`` rows (PRJ-7 with 2, PRJ-8)."""
    big = (rows.groupBy(tid).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") >= F.lit(min_items)).select(tid))
    return rows.join(big, tid, "left_semi")


def trim_baskets(rows: DataFrame, items: DataFrame, min_items: int,
                 tid: str = "tid", item: str = "item", already_distinct: bool = False,
                 limit: int | None = None) -> DataFrame:
    """Keep only the listed items, then drop baskets with fewer than
    ``min_items`` of them (PRJ-6, PRJ-7).  ``limit``: bytes up to which the
    list is broadcast."""
    if not already_distinct:
        rows = distinct_rows(rows, tid, item)
    return keep_baskets(keep_items(rows, items, item, limit=limit), min_items, tid)


# ---------------------------------------------------------------- pairs, triples

def pair_occurrences(rows: DataFrame, tid: str = "tid", item: str = "item",
                     max_group: int = DEFAULT_MAX_GROUP, check_hot: bool = True) -> DataFrame:
    """``(tid, item1, item2)`` with ``item1 < item2`` for every pair of items
    of a basket (CG-1); rows must be distinct."""
    p = pairs_within(rows.select(tid, item), [tid], item, max_group=max_group,
                     check_hot=check_hot)
    return p.select(tid, F.col(item + "_a").alias("item1"), F.col(item + "_b").alias("item2"))


def pair_support(rows: DataFrame, min_support, tid: str = "tid", item: str = "item",
                 discard: bool = True, max_group: int = DEFAULT_MAX_GROUP,
                 n_baskets: int | None = None, already_distinct: bool = False) -> DataFrame:
    """Frequent pairs ``(item1, item2, support)`` (CG-1 / CG-2, AGG-3).

    With ``discard`` the rows are first cut to frequent items (PRJ-5, the
    R-Apriori pass 2); without it every pair is generated and filtered
    afterwards (CG-2).  Both give the same result.  ``n_baskets`` and
    ``already_distinct`` see :func:`prepare`.
    """
    prep = prepare(rows, min_support, tid, item, n_baskets=n_baskets,
                   already_distinct=already_distinct)
    if discard:
        _, rows, widest = frequent_rows(prep, tid, item, max_group=max_group)
    else:
        rows, widest = prep.rows, prep.max_basket
    occ = pair_occurrences(rows, tid, item, max_group, check_hot=widest > max_group)
    counts = occ.groupBy("item1", "item2").agg(F.count(F.lit(1)).alias("support"))
    return frequent(counts, prep.threshold)


def triple_support(rows: DataFrame, pairs: DataFrame, threshold: int,
                   tid: str = "tid", item: str = "item",
                   max_group: int = DEFAULT_MAX_GROUP, check_hot: bool = True,
                   occurrences: DataFrame | None = None) -> DataFrame:
    """Frequent triples ``(item1, item2, item3, support)`` from frequent
    pairs (CG-3, AGG-4).

    Pair occurrences of frequent pairs are joined on ``(tid, item1)``: two
    frequent pairs ``(a, b)``, ``(a, c)`` in one basket give ``(a, b, c)``,
    which is kept if ``(b, c)`` is frequent too.  Items come out sorted.
    ``occurrences`` are the pair occurrences if the caller already has them.
    """
    occ = occurrences if occurrences is not None else \
        pair_occurrences(rows, tid, item, max_group, check_hot)
    occ = join_listed(occ, pairs.select("item1", "item2"), ["item1", "item2"])
    tri = pairs_within(occ, [tid, "item1"], "item2", max_group=max_group, check_hot=check_hot)
    bc = pairs.select(F.col("item1").alias("item2_a"), F.col("item2").alias("item2_b"))
    tri = join_listed(tri, bc, ["item2_a", "item2_b"])
    counts = tri.groupBy("item1", F.col("item2_a").alias("item2"), F.col("item2_b").alias("item3")) \
        .agg(F.count(F.lit(1)).alias("support"))
    return frequent(counts, threshold)
