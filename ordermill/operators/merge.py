"""Upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.dedupe import keep_one


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal keys.

    Rows of ``source`` that share a key are reduced to one first.  A key with a
    NULL equals nothing: such source rows are added, such target rows stay.
    """
    return replace_by_key(target, keep_one(source, keys), keys)


def replace_by_key(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert`` for rows with unique keys, which are read twice: once for the keys, once for the rows.

    The target is read once.  Its rows with a NULL in the key match nothing; a
    hash of the whole row beside the key spreads them over the tasks of the join.
    """
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in target.schema])
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    spread = F.when(complete, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*target.columns))
    replaced = fresh.select(*keys, F.lit(0).cast("bigint").alias("__spread"))
    untouched = target.withColumn("__spread", spread).join(replaced, [*keys, "__spread"], "left_anti")
    return untouched.select(*target.columns).unionByName(fresh)
