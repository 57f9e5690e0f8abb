"""cofreq: frequent itemset mining and market-basket analysis on Spark.

Inputs are long rows ``(tid, item)``; miners return ``(itemset, k,
support)`` DataFrames.  Every step is a DataFrame plan.
"""

from .operators.apriori import apriori, r_apriori
from .operators.candidates import candidates, count_containment, items_in_candidates
from .operators.eclat import eclat, tid_bitsets
from .operators.encode import build_dictionary, decode, dense_ids, encode, encoded_rows
from .operators.fpgrowth import fpgrowth
from .operators.groupjoin import group_join, pairs_within
from .operators.ordered import ordered_patterns, prefixspan
from .operators.prepare import clean_rows, ordered_baskets, profile, to_baskets
from .operators.rules import association_rules
from .operators.support import item_support, min_count, pair_support
from .session import build_session, checkpoint_root, materialize

__all__ = [
    "apriori", "r_apriori", "eclat", "fpgrowth", "association_rules",
    "ordered_patterns", "prefixspan", "candidates", "count_containment",
    "items_in_candidates", "tid_bitsets", "build_dictionary", "encode", "decode",
    "dense_ids", "encoded_rows", "group_join", "pairs_within", "clean_rows",
    "ordered_baskets", "profile", "to_baskets", "item_support", "min_count",
    "pair_support", "build_session", "checkpoint_root", "materialize",
]
