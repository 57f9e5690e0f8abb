"""Sources and sinks: basket text files, delimited files, built-in samples."""

from .builtin import customer_transactions, default_baskets
from .delimited import read_delimited
from .sinks import read_itemsets, write_baskets_text, write_itemsets
from .text import baskets_to_rows, count_lines, read_baskets, read_rows

__all__ = ["read_baskets", "read_rows", "baskets_to_rows", "count_lines", "read_delimited",
           "default_baskets", "customer_transactions", "read_itemsets",
           "write_baskets_text", "write_itemsets"]
