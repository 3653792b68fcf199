"""Positions of rows in a given order within groups, without bringing a group together.

Rows are dealt by ranges of group, order and row number, so that neither a large group nor equal rows land in one
task; each range is sorted, and from the numbers of rows per group and range follows where a range's rows begin.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import materialize


def positioned(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], column: str, label: str) -> DataFrame:
    """``df``, stored, with ``column``: 0-based position in its group by ``order``, NULLs first.

    NULL is a group like any other.  Rows equal in all of ``order`` follow each other in any order.  The keys of the
    order should be short: a sample of them goes to the driver.
    """
    groups = list(groups)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    place = [*groups, *keys, F.col("__row")]
    ranged = numbered.repartitionByRange(*place).sortWithinPartitions(*place).drop("__row")
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), label)
    part = F.expr("shiftright(__at, 33)")
    pieces = stored.groupBy(*groups, part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # A group has at most one piece per partition.
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).select(
        *[F.col(g).alias(f"__{g}") for g in groups], F.col("__part"), (F.col("__before") - F.col("__first")).alias("__shift"))
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups], part == F.col("__part"))
    return stored.join(pieces, same).select(
        *df.columns, (F.col("__at") + F.col("__shift")).alias(column))
