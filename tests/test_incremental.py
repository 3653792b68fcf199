"""Upserts that leave untouched months alone, cleaning by load mark, and ingest as a stream."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.registry import RULES, Tables
from ordermill.operators.merge import replace_by_key
from ordermill.plans import daily_run
from ordermill.plans.daily_run import CLEANED, ITEMS, MONTH, OPTIONS, Run, clean_layer, ingest_raw
from ordermill.sources.lake import CLEAN, FEW_VALUES, RAW, SERVING, Lake, TableSpec
from ordermill.streaming.ingest import extract_stream, ingest_stream, publish_batch

SF = "/root/testdata/sf0.001"
SCHEMA = "k string, m string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def lines(df):
    return sorted((tuple(r) for r in df.select("k", "m", "v").collect()), key=repr)


def months_of(lake, version):
    folder = Path(lake.snapshot_path(RAW, "t", version))
    return sorted(p.name for p in folder.iterdir() if p.name.startswith("m="))


def scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("FileScan")


@pytest.fixture
def months(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.upsert(frame(spark, ("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3), ("n", None, 4), (None, "2024-03", 5)),
                RAW, "t", ["k"], ["m"])
    return lake


def test_only_touched_months_are_written(spark, months):
    months.upsert(frame(spark, ("b", "2024-02", 20), ("d", "2024-04", 9)), RAW, "t", ["k"], ["m"])
    assert months_of(months, 2) == ["m=2024-02", "m=2024-04"]
    assert sorted(map(str, months.content(RAW, "t").reused[1])) == ["2024-01", "2024-03", "None"]
    assert lines(months.read(RAW, "t")) == lines(frame(
        spark, ("a", "2024-01", 1), ("b", "2024-02", 20), ("c", "2024-03", 3), ("n", None, 4), (None, "2024-03", 5), ("d", "2024-04", 9)))
    months.rollback(RAW, "t")
    assert months.read(RAW, "t").count() == 5


def test_a_row_that_moves_leaves_its_month(spark, months):
    months.upsert(frame(spark, ("c", "2024-01", 30), ("n", "2024-01", 40)), RAW, "t", ["k"], ["m"])
    assert lines(months.read(RAW, "t")) == lines(frame(
        spark, ("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-01", 30), ("n", "2024-01", 40), (None, "2024-03", 5)))
    # To NULL and back; the month it leaves is empty and no longer named.
    months.upsert(frame(spark, ("b", None, 21)), RAW, "t", ["k"], ["m"])
    assert ("b", None, 21) in lines(months.read(RAW, "t"))
    held = [v for values in months.content(RAW, "t").reused.values() for v in values] + months.content(RAW, "t").own
    assert "2024-02" not in held and None in held


def test_an_empty_extract_publishes_nothing(spark, months):
    assert months.upsert(frame(spark).limit(0), RAW, "t", ["k"], ["m"]) == 1
    assert months.versions(RAW, "t") == [1]


def test_snapshots_that_are_read_from_stay(spark, tmp_path, months):
    lake = Lake(spark, str(tmp_path), keep=1)
    for v in (21, 22, 23):
        lake.upsert(frame(spark, ("b", "2024-02", v)), RAW, "t", ["k"], ["m"])
    assert lake.versions(RAW, "t") == [1, 4]
    assert ("b", "2024-02", 23) in lines(lake.read(RAW, "t")) and lake.read(RAW, "t").count() == 5


def test_months_are_pruned_over_all_snapshots(spark, months):
    months.upsert(frame(spark, ("b", "2024-02", 20)), RAW, "t", ["k"], ["m"])
    one = months.read(RAW, "t").filter("m = '2024-03'")
    assert lines(one) == lines(frame(spark, ("c", "2024-03", 3), (None, "2024-03", 5)))
    text = one._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [") == text.count("FileScan") and "PartitionFilters: []" not in text


def test_replaced_months_leave_the_others_unread(spark, months, monkeypatch):
    wider = frame(spark, ("e", "2024-02", 7)).withColumn("w", F.lit(1))
    read = []
    monkeypatch.setattr(Lake, "overwrite", lambda self, df, *a, _real=Lake.overwrite, **k: read.append(df) or _real(self, df, *a, **k))
    months.replace_partitions(wider, RAW, "t", "m")
    assert scans(read[0]) == 0  # nothing of the table is in the plan of what is written
    got = {r.k: r.w for r in months.read(RAW, "t").collect()}
    assert got == {"a": None, "e": 1, "c": None, "n": None, None: None}
    assert months_of(months, 2) == ["m=2024-02"]


def test_the_target_is_read_once(spark, tmp_path):
    frame(spark, ("a", "x", 1)).write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    assert scans(replace_by_key(target, frame(spark, ("a", "x", 2)), ["k", "m"])) == 1


def test_marks_go_along(spark, months):
    months.upsert(frame(spark, ("a", "2024-01", 2)), RAW, "t", ["k"], ["m"], marks={"x": "1"})
    months.upsert(frame(spark, ("a", "2024-01", 3)), RAW, "t", ["k"], ["m"], marks={"y": "2"})
    assert months.marks(RAW, "t") == {"x": "1", "y": "2"}
    months.rollback(RAW, "t")
    assert months.marks(RAW, "t") == {"x": "1"}


# --- cleaning by load mark ---


def test_only_new_loads_are_cleaned(spark, tmp_path, monkeypatch):
    tables, lake = Tables(spark, SF), Lake(spark, str(tmp_path))

    def step(day, read, **more):
        run = Run(lake, read, day, day, RULES, **more)
        ingest_raw(run)
        assert set(clean_layer(run).values()) == {"SUCCESS"}
        return run

    first = step("2026-01-01", tables.source)
    everything = first.stage_counts[ITEMS]["rows_in"]
    version = lake.current(CLEAN, ITEMS)

    nothing = step("2026-01-02", lambda spec: tables.source(spec).limit(0) if spec.name != daily_run.CALENDAR else tables.source(spec))
    assert ITEMS not in nothing.stage_counts and OPTIONS not in nothing.stage_counts
    assert lake.current(CLEAN, ITEMS) == version
    unseen = lake.read(RAW, ITEMS).filter((F.col("ingestion_date") > "2026-01-01") | (F.col("ingestion_date") == "2026-01-02"))
    assert unseen.inputFiles() == [] or unseen.isEmpty()

    some = tables.raw_items.filter("CREATION_TIME_UTC LIKE '2022-03%'").withColumn(
        "ITEM_NAME", F.concat("ITEM_NAME", F.lit(" new")))
    later = {ITEMS: some, OPTIONS: tables.raw_options.limit(0), daily_run.CALENDAR: tables.raw_calendar}
    third = step("2026-01-03", lambda spec: later[spec.name])
    assert 0 < third.stage_counts[ITEMS]["rows_in"] == some.select("ORDER_ID", "LINEITEM_ID").distinct().count() < everything
    assert lake.content(CLEAN, ITEMS).own == ["2022-03"] and lake.marks(CLEAN, ITEMS)[CLEANED] == "2026-01-03"

    # The same as cleaning all of raw into an empty layer.
    whole = daily_run.clean_order_items(lake.read(RAW, ITEMS), RULES).drop("silver_ingestion_ts")
    stored = lake.read(CLEAN, ITEMS).drop("silver_ingestion_ts", MONTH).select(*whole.columns)
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()

    again = step("2026-01-04", lambda spec: later[spec.name].limit(0) if spec.name != daily_run.CALENDAR else later[spec.name], clean_all=True)
    assert again.stage_counts[ITEMS]["rows_in"] == lake.read(RAW, ITEMS).count()


# --- stream ---

SPEC = TableSpec("t", ("k",))


def extract(spark, folder, day, *rows):
    frame(spark, *rows).write.parquet(f"{folder}/load={day}")


def state(lake):
    return sorted((tuple(r) for r in lake.read(RAW, "t").select("k", "m", "v", "load").collect()), key=repr)


def run_stream(spark, lake, folder, **more):
    ingest_stream(lake, extract_stream(spark, str(folder), frame(spark).schema, "load", **more), SPEC, "load")


def test_stream_takes_each_extract_once(spark, tmp_path):
    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "in"
    extract(spark, folder, "2024-01-01", ("a", "x", 1), ("b", "x", 2), ("b", "x", 9))
    run_stream(spark, lake, folder)
    extract(spark, folder, "2024-01-02", ("b", "y", 3), ("c", "y", 4))
    run_stream(spark, lake, folder)
    want = [("a", "x", 1, "2024-01-01"), ("b", "y", 3, "2024-01-02"), ("c", "y", 4, "2024-01-02")]
    assert state(lake) == want
    versions = lake.versions(RAW, "t")
    run_stream(spark, lake, folder)  # nothing has arrived
    assert lake.versions(RAW, "t") == versions
    # A batch that comes again.
    assert not publish_batch(lake, SPEC, frame(spark, ("a", "z", 0)).withColumn("load", F.lit("2024-01-09")), 1, "stream", "load")
    assert state(lake) == want


@pytest.mark.parametrize("files", [None, 1])
def test_all_extracts_at_once_and_a_late_one(spark, tmp_path, files):
    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "in"
    extract(spark, folder, "2024-01-02", ("a", "x", 2), ("b", "x", 2))
    extract(spark, folder, "2024-01-03", ("b", "y", 3))
    run_stream(spark, lake, folder, files_per_batch=files)
    extract(spark, folder, "2024-01-01", ("a", "w", 1), ("c", "w", 1))  # older than what is there
    run_stream(spark, lake, folder, files_per_batch=files)
    assert state(lake) == [("a", "x", 2, "2024-01-02"), ("b", "y", 3, "2024-01-03"), ("c", "w", 1, "2024-01-01")]


def test_a_stop_between_publishing_and_recording(spark, tmp_path, monkeypatch):
    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "in"
    extract(spark, folder, "2024-01-01", ("a", "x", 1), (None, "x", 2))
    real = Lake.upsert

    def stops(self, *args, **named):
        real(self, *args, **named)
        raise RuntimeError("the job ended here")

    monkeypatch.setattr(Lake, "upsert", stops)
    with pytest.raises(Exception, match="the job ended here"):
        run_stream(spark, lake, folder)
    monkeypatch.setattr(Lake, "upsert", real)
    before, versions = state(lake), lake.versions(RAW, "t")
    run_stream(spark, lake, folder)
    # Without the mark the row without a key would be there twice.
    assert state(lake) == before == [("a", "x", 1, "2024-01-01"), (None, "x", 2, "2024-01-01")]
    assert lake.versions(RAW, "t") == versions


def test_serving_tables_are_not_touched_by_ingest(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert not lake.exists(SERVING, "fact_orders") and lake.marks(SERVING, "fact_orders") == {}


def test_extracts_of_one_load_date_are_shuffled_for_the_merge_only(spark, tmp_path, monkeypatch):
    """Neither brought together by load date nor joined to find the last one."""
    seen, overwrite = [], Lake.overwrite
    monkeypatch.setattr(Lake, "overwrite", lambda self, df, layer, table, partition_by=(), rebalance=False, *more, **named: (
        seen.append(rebalance), overwrite(self, df, layer, table, partition_by, rebalance, *more, **named))[1])
    monkeypatch.setattr("ordermill.streaming.ingest.keep_latest", None)
    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "extracts"
    for day, value in (("2024-01-01", 1), ("2024-01-02", 2)):
        extract(spark, folder, day, ("a", "x", value))
        run_stream(spark, lake, folder)
    ingest_raw(Run(lake, lambda spec: frame(spark, ("a", "x", 3)), "2024-01-03", "", sources=(TableSpec("raw", SPEC.keys),)))
    assert seen == [False] * 3
    assert lines(lake.read(RAW, "raw").select(*frame(spark).columns)) == [("a", "x", 3)]


def test_many_load_dates_are_brought_together(spark, tmp_path, monkeypatch):
    seen, overwrite = [], Lake.overwrite
    monkeypatch.setattr(Lake, "overwrite", lambda self, df, layer, table, partition_by=(), rebalance=False, *more, **named: (
        seen.append(rebalance), overwrite(self, df, layer, table, partition_by, rebalance, *more, **named))[1])
    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "extracts"
    for n in range(FEW_VALUES + 1):
        extract(spark, folder, f"2024-01-0{n + 1}", (f"k{n}", "x", n))
    run_stream(spark, lake, folder)
    assert seen == [True] and lake.read(RAW, SPEC.name).count() == FEW_VALUES + 1
