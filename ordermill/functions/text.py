"""Cleaning of text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings read as true and as false.
STRICT_TRUE, STRICT_FALSE = ("TRUE",), ("FALSE",)
WIDE_TRUE, WIDE_FALSE = ("TRUE", "T", "1", "YES", "Y"), ("FALSE", "F", "0", "NO", "N")


def text_to_bool(col: Column, wide: bool = False) -> Column:
    """TRUE/FALSE in any case, NULL for anything else; ``wide`` also takes T, 1, YES, ... and blanks around."""
    text = F.upper(col.cast("string"))
    yes, no = (WIDE_TRUE, WIDE_FALSE) if wide else (STRICT_TRUE, STRICT_FALSE)
    if wide:
        text = F.trim(text)
    return F.when(text.isin(*yes), True).when(text.isin(*no), False)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


# How a damaged category name is recognised, the texts looked for, and the category it stands for.
CATEGORY_REPAIRS = (
    ("blank", (), "Unknown"),
    ("contains", ("BBQ Plates",), "BBQ Plates"),
    ("equals", ("Bowls0",), "Bowls"),
    ("matches", (r"^\s*Sandwiches.*$",), "Sandwiches"),
    ("contains", ("Drip C", "offee"), "Drip Coffee"),
    ("equals", ("Sqalads",), "Salads"),
    ("equals", ("Kids",), "Kid's"),
    ("starts with", ("Kid's",), "Kid's"),
)

TESTS = {
    "equals": Column.__eq__,
    "contains": Column.contains,
    "starts with": Column.startswith,
    "matches": Column.rlike,
}


def tidy_category(col: Column, repairs: Sequence[tuple[str, tuple[str, ...], str]] = CATEGORY_REPAIRS) -> Column:
    """The label of the first repair (test, texts that all have to pass it, label) that fits, else the trimmed name."""
    chain = F
    for test, texts, label in repairs:
        fits = blank_to_null(col).isNull() if test == "blank" else reduce(and_, [TESTS[test](col, t) for t in texts])
        chain = chain.when(fits, F.lit(label))
    return chain.otherwise(F.trim(col))


def tidy_option_group(col: Column) -> Column:
    """Trim, drop a leading "CT " in any case, and capitalise words so that spellings fall together."""
    return F.initcap(F.regexp_replace(F.trim(col), r"(?i)^CT\s+", ""))
