"""Column expressions used by the operators.

All of them are built-in Spark expressions (JVM side, inside whole-stage
codegen); nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

# The blank is the item separator of basket text lines, and
# the retail date format is month/day/year hour:minute:second.
BLANKS = " +"
RETAIL_DATE_PATTERN = r"^\d\d/\d\d/\d\d\d\d \d\d:\d\d:\d\d$"
RETAIL_DATE_FORMAT = "MM/dd/yyyy HH:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(line, sep: str = BLANKS) -> Column:
    """Split a text line into non-empty tokens (PRJ-1).

    Spark's ``split`` keeps empty tokens for leading / doubled / trailing
    separators; they are removed here so ``"1  2 "`` gives ``["1", "2"]``.
    """
    return F.filter(F.split(_c(line), sep), lambda t: t != F.lit(""))


def cast_items(items, to: str = "int", lenient: bool = True) -> Column:
    """Cast every token of an array; lenient mode drops tokens that do not
    parse (SRC-4), strict mode raises under ANSI like ``Integer.parseInt``."""
    if lenient:
        return F.filter(F.transform(_c(items), lambda t: t.try_cast(to)),
                        lambda t: t.isNotNull())
    return F.transform(_c(items), lambda t: t.cast(to))


def comma_items(col, to: str = "int") -> Column:
    """Parse a comma-joined item list such as ``"1,3,4"`` (SRC-4)."""
    return cast_items(F.split(F.trim(_c(col)), r"\s*,\s*"), to, lenient=True)


def contains_all(basket, itemset) -> Column:
    """True when ``basket`` holds every item of ``itemset`` (SET-1)."""
    return F.size(F.array_except(_c(itemset), _c(basket))) == 0


def intersect(basket, items) -> Column:
    """Items of ``basket`` that are also in ``items`` (SET-2)."""
    return F.array_intersect(_c(basket), _c(items))


def add_item(itemset, item) -> Column:
    """Sorted union of an itemset with one more item (SET-3)."""
    return F.array_sort(F.array_union(_c(itemset), F.array(_c(item))))


def empty_array(element_type: DataType) -> Column:
    return F.array().cast(ArrayType(element_type))


def bit_word(dense_tid) -> Column:
    """64 transactions share one BIGINT word of a tid bitset."""
    return F.call_function("div", _c(dense_tid).cast("bigint"), F.lit(64).cast("bigint"))


def bit_mask(dense_tid) -> Column:
    """The single bit of ``dense_tid`` inside its word (AGG-8)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"),
                           F.pmod(_c(dense_tid), F.lit(64)).cast("int"))


def popcount(bits) -> Column:
    """Number of transactions in a bitset word (AGG-9)."""
    return F.bit_count(_c(bits)).cast("bigint")


def itemset_text(itemset, sep: str = "|") -> Column:
    """Canonical text of an itemset: items cast to string, joined by ``sep``
    in the order of the array (sort it first for set semantics)."""
    return F.concat_ws(sep, F.transform(_c(itemset), lambda x: x.cast("string")))


def retail_time(col) -> Column:
    """Parse ``MM/dd/yyyy HH:mm:ss`` leniently (PRJ-12); bad values -> null."""
    return F.when(_c(col).rlike(RETAIL_DATE_PATTERN),
                  F.try_to_timestamp(_c(col), F.lit(RETAIL_DATE_FORMAT)))
