"""Calendar files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.schemas import RAW_CALENDAR


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_CALENDAR).option("header", True).csv(path)
