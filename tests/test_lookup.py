"""One customer's rows are found without reading the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.registry import Tables
from ordermill.plans.cleaning import ItemRules, clean_order_items
from ordermill.plans.reports import trajectory
from ordermill.schemas import LOOKUP_COLUMNS, PARTITION_COLUMNS
from ordermill.sources.lake import SERVING, Lake

SF, TABLE = "/root/testdata/sf0.001", "gold_clv_snapshot"


def bytes_read(spark, action) -> int:
    def total() -> int:
        statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in statistics)

    before = total()
    action()
    return total() - before


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    # Reads of several ranges at once are not counted by the local file system.
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.hadoop.vectored.io.enabled", "false")
    lake = Lake(spark, str(tmp_path_factory.mktemp("lookup")))
    clv = Tables(spark, SF).clv
    # Twenty times the customers, and spend that does not compress, so that the files are more than their footers.
    many = clv.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn(
        "user_id", F.concat("user_id", F.lit("-"), F.col("n").cast("string"))).drop("n").withColumn(
        "cumulative_spend", (F.abs(F.xxhash64("user_id", "date_key")) % 10**12 / 100).cast("decimal(18,2)"))
    many = many.repartitionByRange(8, "user_id", "date_key").sortWithinPartitions("user_id", "date_key")
    lake.overwrite(many, SERVING, TABLE, [PARTITION_COLUMNS[TABLE]], lookup=LOOKUP_COLUMNS[TABLE])
    yield lake
    settings.unset("parquet.hadoop.vectored.io.enabled")


def test_a_customer_is_read_without_the_others(spark, stored):
    table = stored.load(TABLE)
    columns = ["user_id", "date_key", "cumulative_spend", "daily_revenue", "clv_tier"]
    whole = bytes_read(spark, lambda: table.select(*columns).write.format("noop").mode("overwrite").save())
    customer = table.select("user_id").orderBy(F.desc("user_id")).first()[0]
    rows = []
    one = bytes_read(spark, lambda: rows.extend(trajectory(table, customer).collect()))
    assert rows and 10 * one < whole, (one, whole)
    none = bytes_read(spark, lambda: trajectory(table, "9-nobody").collect())
    assert none <= one


def test_no_company_is_built_in(spark):
    rules = ItemRules()
    assert not rules.excluded_apps and not rules.excluded_restaurants
    raw = Tables(spark, SF).raw_items
    kept = clean_order_items(raw, rules)
    assert kept.filter("APP_NAME = 'Shop - DEVELOPMENT'").count() > 0
    named = clean_order_items(raw, ItemRules(excluded_apps=("Shop - DEVELOPMENT",)))
    assert named.filter("APP_NAME = 'Shop - DEVELOPMENT'").count() == 0
