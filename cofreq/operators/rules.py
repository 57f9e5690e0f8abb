"""Association rules ``A => c`` from frequent itemsets (MINE-6).

For every frequent itemset X with at least two items and every item c of X,
the rule ``X - {c} => c`` has support sup(X), confidence sup(X) / sup(X - c)
and lift confidence / (sup(c) / n).  Both lookups are equi-joins on the
itemset array; no rule is built on the driver.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .support import as_fraction


def association_rules(itemsets: DataFrame, min_confidence=0.0, n_baskets: int | None = None,
                      itemset: str = "itemset") -> DataFrame:
    """``(antecedent, consequent, support, antecedent_support,
    consequent_support, confidence, lift)``.

    ``itemsets`` is a miner result with all levels: a rule whose antecedent
    or consequent is not among them stops the job.  ``min_confidence`` is
    compared exactly, in DECIMAL: ``support * den >= num *
    antecedent_support``.  ``lift`` needs
    ``n_baskets``; it is null without it.
    """
    # supports have up to 19 digits, so 18 are left for the fraction's terms
    conf = as_fraction(min_confidence).limit_denominator(10 ** 17)
    sets = itemsets.select(F.col(itemset).alias("_set"), F.col("support"))
    big = sets.where(F.size("_set") >= 2)
    rules = big.select("_set", "support", F.explode("_set").alias("consequent")) \
        .withColumn("antecedent", F.filter("_set", lambda x: x != F.col("consequent")))
    ante = sets.select(F.col("_set").alias("antecedent"),
                       F.col("support").alias("antecedent_support"))
    singles = broadcast_if_small(
        sets.where(F.size("_set") == 1)
        .select(F.col("_set")[0].alias("consequent"), F.col("support").alias("consequent_support")))
    def present(c: str, of: str):
        return F.coalesce(c, F.raise_error(F.concat(
            F.lit(f"no support for the {of} of a rule (all levels are needed): "),
            F.col(of).cast("string"))))

    def times(c: str, n: int):
        return F.col(c).cast("decimal(19,0)") * F.lit(Decimal(n)).cast("decimal(18,0)")

    out = (rules.join(ante, "antecedent", "left").join(singles, "consequent", "left")
           .withColumn("antecedent_support", present("antecedent_support", "antecedent"))
           .withColumn("consequent_support", present("consequent_support", "consequent"))
           .where(times("support", conf.denominator) >= times("antecedent_support", conf.numerator)))
    confidence = F.col("support") / F.col("antecedent_support")
    lift = (confidence * F.lit(n_baskets) / F.col("consequent_support")) if n_baskets \
        else F.lit(None).cast("double")
    return out.select("antecedent", "consequent",
                      F.col("support").cast("bigint"),
                      F.col("antecedent_support").cast("bigint"),
                      F.col("consequent_support").cast("bigint"),
                      confidence.alias("confidence"), lift.alias("lift"))
