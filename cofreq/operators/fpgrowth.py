"""FP-Growth through Spark's own parallel implementation (MINE-5).

``pyspark.ml.fpm.FPGrowth`` is PFP: frequent items are counted in a
distributed job, transactions are split into conditional databases per item
group and trees are grown per group in parallel.  It needs one array per
basket, built here from long rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .prepare import to_baskets
from .support import frequent_rows, prepare


def fraction_for_count(m: int, n: int) -> float:
    """A ``minSupport`` share for which Spark's ``ceil(share * n)`` is
    exactly ``m``; ``m / n`` itself may round up to ``m + 1``."""
    return (m - 0.5) / n


def fpgrowth(rows: DataFrame, min_support, *, tid: str = "tid", item: str = "item",
             num_partitions: int | None = None, max_len: int | None = None,
             n_baskets: int | None = None) -> DataFrame:
    """``(itemset, k, support)`` with sorted itemsets, like the other miners.

    Baskets are cut to frequent items first, so an array holds at most as many
    items as are frequent.  ``n_baskets`` see :func:`support.prepare`.
    """
    prep = prepare(rows, min_support, tid, item, n_baskets=n_baskets)
    m = prep.threshold
    _, kept, _ = frequent_rows(prep, tid, item)
    if kept.isEmpty():
        return kept.select(F.array(item).alias("itemset"), F.lit(0).cast("int").alias("k"),
                           F.lit(0).cast("bigint").alias("support")).limit(0)
    baskets = materialize(to_baskets(kept, tid, item, "items"), "baskets")
    release(kept, prep.rows)
    fp = FPGrowth(itemsCol="items", minSupport=fraction_for_count(m, baskets.count()),
                  minConfidence=0.0)
    if num_partitions:
        fp = fp.setNumPartitions(int(num_partitions))
    model = fp.fit(baskets)
    out = model.freqItemsets.select(F.array_sort("items").alias("itemset"),
                                    F.size("items").cast("int").alias("k"),
                                    F.col("freq").cast("bigint").alias("support"))
    out = out.where(F.col("support") >= m)
    if max_len is not None:
        out = out.where(F.col("k") <= max_len)
    return out
