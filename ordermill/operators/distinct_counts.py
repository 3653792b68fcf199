"""Several distinct counts of one grouping without multiplying the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_distinct_counts(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[Column], counted: Mapping[str, str],
) -> DataFrame:
    """One row per group with ``measures`` and, by name, the distinct values of each counted column.

    More than one distinct count in an aggregate makes Spark repeat every row for each of them.  Here each
    is an aggregate of its own, and these are joined; worth it where ``rows`` are stored and narrow.
    """
    (first, column), *others = counted.items()
    result = rows.groupBy(*keys).agg(*measures, F.count_distinct(column).alias(first))
    for name, column in others:
        counts = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count_distinct(column).alias(name))
        same = reduce(and_, [result[k].eqNullSafe(counts[f"_{k}"]) for k in keys])
        result = result.join(counts, same).drop(*[f"_{k}" for k in keys])
    return result
