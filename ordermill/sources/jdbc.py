"""Partitioned reads over JDBC; address, driver and credentials are the caller's."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


def day_predicates(column: str, start: date, end: date, days: int) -> list[str]:
    """Disjoint WHERE clauses that together cover every row, also before, after and without a date."""
    edges = [start + timedelta(days=i) for i in range(0, (end - start).days + 1, days)]
    text = [edge.isoformat() for edge in edges]
    inner = [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(text, text[1:])]
    return [f"{column} < '{text[0]}' OR {column} IS NULL", *inner, f"{column} >= '{text[-1]}'"]


def range_options(column: str, lower: int | str, upper: int | str, partitions: int) -> dict[str, str]:
    """Options that make Spark split the read by ranges of a numeric, date or timestamp column."""
    return {
        "partitionColumn": column, "lowerBound": str(lower),
        "upperBound": str(upper), "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    predicates: Sequence[str] | None = None, split: dict[str, str] | None = None, fetch_size: int = 10000,
) -> DataFrame:
    """A source table, read by one task per predicate or per range of ``split``.

    One of the two is needed: without them JDBC reads the whole table in one task.
    """
    if not predicates and not split:
        raise ValueError("give predicates or split, otherwise one task reads the whole table")
    options = {**properties, "fetchsize": str(fetch_size)}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options, **split).load()
