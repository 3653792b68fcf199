"""What writes leave on disk besides their result."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from ordermill.plans.daily_run import Once
from ordermill.session import CONCURRENT_WRITERS, SHUFFLE_CLEANUP, allow_unsorted_writes, materialize, scratch_root, scratch_scope
from ordermill.sources.lake import RAW, SIDE_BY_SIDE, Lake


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def leaves_none(spark, write):
    before = shuffle_files(spark)
    write()
    until = time.time() + 10  # executors are told to, not waited for
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


def scratch(spark):
    root = Path(scratch_root(spark).removeprefix("file:"))
    return {p.name for p in root.iterdir() if p.is_dir()}


def grouped(spark):
    return spark.range(2000, numPartitions=3).groupBy((F.col("id") % 97).cast("string").alias("k")).agg(F.sum("id").alias("v"))


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    lake, setting = Lake(spark, str(tmp_path)), spark.conf.get(SHUFFLE_CLEANUP, None)
    assert leaves_none(spark, lambda: materialize(grouped(spark), "grouped"))
    assert leaves_none(spark, lambda: lake.upsert(grouped(spark), RAW, "t", ["k"]))
    assert leaves_none(spark, lambda: lake.upsert(grouped(spark), RAW, "t", ["k"]))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting and lake.read(RAW, "t").count() == 97


def test_an_extract_goes_after_its_merge(spark, tmp_path):
    lake, before = Lake(spark, str(tmp_path)), scratch(spark)
    for _ in range(2):
        lake.upsert(grouped(spark), RAW, "t", ["k"])
    assert scratch(spark) == before and lake.read(RAW, "t").count() == 97


def test_a_scope_takes_its_own_steps_only(spark):
    before = scratch(spark)
    shared = Once(lambda: materialize(grouped(spark), "shared"))
    with scratch_scope():
        own = materialize(grouped(spark), "own")
        assert own.join(shared(), ["k", "v"]).count() == 97
    left = scratch(spark) - before
    assert len(left) == 1 and left.pop().startswith("shared-") and shared().count() == 97


def test_rows_are_not_sorted_by_year_before_they_are_written(spark, tmp_path):
    """Up to so many values side by side; a task with more of them still writes all its rows."""
    lake = Lake(spark, str(tmp_path))
    assert int(spark.conf.get(CONCURRENT_WRITERS)) == SIDE_BY_SIDE
    rows = spark.range(3000, numPartitions=1).select("id", (F.col("id") % (3 * SIDE_BY_SIDE)).alias("m"))
    lake.overwrite(rows, RAW, "t", ["m"])
    assert lake.read(RAW, "t").exceptAll(rows).isEmpty() and lake.read(RAW, "t").count() == 3000
    spark.conf.set(CONCURRENT_WRITERS, "3")
    try:
        allow_unsorted_writes(spark, SIDE_BY_SIDE)
        assert spark.conf.get(CONCURRENT_WRITERS) == "3"
    finally:
        spark.conf.set(CONCURRENT_WRITERS, str(SIDE_BY_SIDE))


def test_snapshots_are_compressed_by_zstandard(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(grouped(spark), RAW, "t")
    assert [p for p in Path(lake.snapshot_path(RAW, "t", 1)).iterdir() if p.name.endswith(".zstd.parquet")]
