"""Skew-safe equi-joins inside groups.

Every miner ends up joining rows that share a group key: items of one
basket (pair generation), frequent sets that share a prefix (candidate
generation), bitset words of one tid block (ECLAT), pattern occurrences and
later items of one sequence (ordered patterns).  A plain equi-join sends a
whole group to one task, and a group may hold a third of all rows.

``group_join`` splits such groups.  A group with ``n`` rows on a side is
cut into ``ceil(n / max_group)`` hash blocks of that side; block ``i`` of
the left meets block ``j`` of the right in its own join key
``(keys, i, j)``.  Every left/right row pair of a group meets in exactly one
cell and no cell holds more than about ``2 * max_group`` rows, so the work of
a hot group is spread over many tasks while the result stays exact.  Groups
under the limit keep a single cell and cost nothing extra.

Which groups are hot is measured with a partial aggregate (map-side
combined) before the join; the hot-group list is broadcast only when its
measured size allows, otherwise it is shuffle-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

# Largest number of rows of one group (per side) a single join cell holds.
DEFAULT_MAX_GROUP = 4096


def hot_groups(df: DataFrame, keys: Sequence[str], name: str, max_group: int) -> DataFrame:
    """Groups of ``df`` with more than ``max_group`` rows, with their block
    count in column ``name``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > F.lit(max_group))
            .select(*keys, F.ceil(F.col("_rows") / F.lit(max_group)).cast("int").alias(name)))


def _measure_hot(left: DataFrame, right: DataFrame | None, keys: list[str],
                 max_group: int) -> DataFrame | None:
    """The hot groups with block counts ``_nl`` / ``_nr`` (written and, when
    its measured size allows, broadcast), or None when there are none.
    ``right=None`` means a self-join: sizes are measured once."""
    hot_l = hot_groups(left, keys, "_nl", max_group)
    if right is None:
        hot = hot_l.select(*keys, "_nl", F.col("_nl").alias("_nr"))
    else:
        hot = hot_l.join(hot_groups(right, keys, "_nr", max_group), keys, "full")
    if hot.limit(1).count() == 0:
        return None
    hot = materialize(hot.fillna(1, ["_nl", "_nr"]), "hot-groups")
    return broadcast_if_small(hot)


def _blocked_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame,
                  left_spread: Sequence[str], right_spread: Sequence[str],
                  parts: int | None = None) -> DataFrame:
    def blocked(side: DataFrame, own: str, other: str, spread: Sequence[str],
                own_blk: str, other_blk: str) -> DataFrame:
        n_own = F.coalesce(F.col(own), F.lit(1))
        n_other = F.coalesce(F.col(other), F.lit(1))
        return (side.join(hot, keys, "left")
                .withColumn(own_blk, F.pmod(F.xxhash64(*spread), n_own).cast("int"))
                .withColumn(other_blk, F.explode(F.sequence(F.lit(0), n_other - 1)))
                .drop("_nl", "_nr"))

    lb = blocked(left, "_nl", "_nr", left_spread, "_bl", "_br")
    rb = blocked(right, "_nr", "_nl", right_spread, "_br", "_bl")
    cell = keys + ["_bl", "_br"]
    return _dealt(lb, parts, cell).join(_dealt(rb, parts, cell), cell, "inner").drop("_bl", "_br")


def _dealt(side: DataFrame, parts: int | None, keys: list[str]) -> DataFrame:
    return side.repartition(parts, *keys) if parts else side


def group_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *,
               left_spread: Sequence[str], right_spread: Sequence[str],
               condition: Column | None = None,
               max_group: int = DEFAULT_MAX_GROUP,
               same_sizes: bool = False,
               check_hot: bool = True, parts: int | None = None) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``keys`` (plus ``condition``)
    in which no task holds more than about ``2 * max_group`` rows of a key.

    ``left_spread`` / ``right_spread`` are columns that vary inside a group
    (e.g. the item); their hash picks a row's block.  ``same_sizes`` says the
    two sides have equal group sizes (a self-join), so sizes are measured
    once.  ``check_hot=False`` skips the measurement when the caller has
    already proven every group is small.  ``parts`` is the number of
    partitions to join in, where the caller knows how many rows meet; by default
    Spark decides, which knows the bytes that are shuffled but not what a row
    meets.
    """
    keys = list(keys)
    hot = _measure_hot(left, None if same_sizes else right, keys, max_group) \
        if check_hot else None
    if hot is None:
        joined = _dealt(left, parts, keys).join(_dealt(right, parts, keys), keys, "inner")
    else:
        joined = _blocked_join(left, right, keys, hot, left_spread, right_spread, parts)
    return joined.where(condition) if condition is not None else joined


def pairs_within(df: DataFrame, keys: Sequence[str], item: str, *,
                 payload: Sequence[str] = (), suffixes: tuple[str, str] = ("_a", "_b"),
                 max_group: int = DEFAULT_MAX_GROUP, check_hot: bool = True) -> DataFrame:
    """Every pair of rows of a group with ``item_a < item_b``.

    Output columns: ``keys``, ``item_a``, ``item_b`` and ``p_a``, ``p_b`` for
    each payload column ``p``.  Items must be distinct inside a group.
    Without hot groups this is a self-join of one plan, so Spark shuffles the
    rows once and reuses the exchange for the other side.
    """
    sa, sb = suffixes
    keys = list(keys)
    cols = [item, *payload]
    base = df.select(*keys, *cols)
    hot = _measure_hot(base, None, keys, max_group) if check_hot else None
    if hot is None:
        a, b = base.alias("_pa"), base.alias("_pb")
        cond = F.col(f"_pa.{item}") < F.col(f"_pb.{item}")
        for k in keys:
            cond = (F.col(f"_pa.{k}") == F.col(f"_pb.{k}")) & cond
        return a.join(b, cond, "inner").select(
            *[F.col(f"_pa.{k}").alias(k) for k in keys],
            *[F.col(f"_pa.{c}").alias(c + sa) for c in cols],
            *[F.col(f"_pb.{c}").alias(c + sb) for c in cols])

    def side(sfx: str) -> DataFrame:
        return base.select(*keys, *[F.col(c).alias(c + sfx) for c in cols])

    joined = _blocked_join(side(sa), side(sb), keys, hot, [item + sa], [item + sb])
    return joined.where(F.col(item + sa) < F.col(item + sb))
