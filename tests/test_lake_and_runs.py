from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.registry import RULES, Tables
from ordermill.operators.merge import upsert
from ordermill.plans.daily_run import ITEMS, Run, run_daily
from ordermill.sources.jdbc import day_predicates, range_options, read_table
from ordermill.sources.lake import CLEAN, RAW, SERVING, Lake
from ordermill.sources.run_log import append_run, overall_status, read_log, retention_gate, table_runs, volume_gate, volume_status
from ordermill.schemas import SERVING_TABLES

SF = "/root/testdata/sf0.001"


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k string, j int, v int")


def lines(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert(spark):
    target = frame(spark, ("a", 1, 10), ("b", 1, 20), (None, 1, 30))
    source = frame(spark, ("b", 1, 21), ("b", 1, 99), ("c", 1, 40), (None, 1, 31))
    merged = upsert(target, source, ["k", "j"])
    assert lines(merged) == lines(frame(spark, ("a", 1, 10), ("b", 1, 21), ("c", 1, 40), (None, 1, 30), (None, 1, 31)))
    known = source.dropna()
    once = upsert(target, known, ["k", "j"])
    assert lines(upsert(once, known, ["k", "j"])) == lines(once)


def test_snapshots(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert not lake.exists(RAW, "t") and lake.versions(RAW, "t") == []
    with pytest.raises(FileNotFoundError):
        lake.read(RAW, "t")
    first = frame(spark, ("a", 1, 10), ("b", 2, 20))
    lake.upsert(first, RAW, "t", ["k"], ["j"])
    lake.upsert(frame(spark, ("b", 3, 21)), RAW, "t", ["k"], ["j"])
    assert lines(lake.read(RAW, "t").select("k", "j", "v")) == [("a", 1, 10), ("b", 3, 21)]
    assert lake.rollback(RAW, "t") == 1
    assert lines(lake.read(RAW, "t").select("k", "j", "v")) == [("a", 1, 10), ("b", 2, 20)]
    with pytest.raises(ValueError):
        lake.rollback(RAW, "t")
    # A new snapshot never takes the number of one that was rolled back.
    assert lake.overwrite(first, RAW, "t") == 3


def test_an_upsert_asks_the_source_once(spark, tmp_path):
    """A source that gives other rows each time it is read must not leave rows of two reads in the table."""
    lake = Lake(spark, str(tmp_path))
    lake.upsert(frame(spark, ("a", 1, 10)), RAW, "t", ["k"])
    restless = spark.range(50).select(
        F.uuid().alias("k"), F.lit(1).alias("j"), F.lit(2).alias("v"))
    lake.upsert(restless, RAW, "t", ["k"])
    assert lake.read(RAW, "t").count() == lake.read(RAW, "t").select("k").distinct().count() == 51


def test_old_snapshots_go(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), keep=2)
    for v in range(4):
        lake.overwrite(frame(spark, ("a", 1, v)), RAW, "t")
    assert lake.versions(RAW, "t") == [3, 4]
    lake.rollback(RAW, "t")
    lake.drop_old(RAW, "t", 1)
    assert lake.versions(RAW, "t") == [3, 4] and lines(lake.read(RAW, "t")) == [("a", 1, 2)]


def test_partitions_keep_their_types_and_can_be_replaced(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    orders = spark.createDataFrame([("1", "2020-01", 5), ("2", "2020-02", 6)], "id string, m string, v int")
    lake.overwrite(orders, SERVING, "fact_orders", ["m"], rebalance=True)
    assert dict(lake.load("fact_orders").dtypes)["m"] == "string"
    lake.replace_partitions(spark.createDataFrame([("3", "2020-02", 7)], orders.schema), SERVING, "fact_orders", "m")
    assert lines(lake.load("fact_orders").select("id", "m", "v")) == [("1", "2020-01", 5), ("3", "2020-02", 7)]
    lake.replace_partitions(orders.limit(0), SERVING, "fact_orders", "m", ["2020-01"])  # nothing left: it goes
    assert lines(lake.load("fact_orders").select("id", "m", "v")) == [("3", "2020-02", 7)]
    lake.rollback(SERVING, "fact_orders", 1)
    assert lines(lake.load("fact_orders").select("id", "m", "v")) == [("1", "2020-01", 5), ("2", "2020-02", 6)]


@pytest.mark.parametrize("damage", ["", "\n", "snapshot?\n", None])
def test_a_damaged_pointer_is_an_error(spark, tmp_path, damage):
    lake = Lake(spark, str(tmp_path))
    assert not lake.exists(RAW, "t")
    lake.overwrite(frame(spark, ("a", 1, 1), ("b", 1, 2)), RAW, "t")
    pointer = tmp_path / RAW / "t" / "_CURRENT"
    pointer.unlink()
    (tmp_path / RAW / "t" / "._CURRENT.crc").unlink(missing_ok=True)
    if damage is not None:
        pointer.write_text(damage)
    with pytest.raises(RuntimeError, match="_CURRENT"):
        lake.upsert(frame(spark, ("c", 1, 3)), RAW, "t", ["k"])
    lake.publish(RAW, "t", 1)
    lake.upsert(frame(spark, ("c", 1, 3)), RAW, "t", ["k"])
    assert lake.read(RAW, "t").count() == 3


def test_unknown_names_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown table"):
        Lake(spark, str(tmp_path)).load("nope")


def test_status():
    assert overall_status({"a": "SUCCESS", "b": "SUCCESS"}) == "SUCCESS"
    assert overall_status({"a": "SUCCESS", "b": "FAILED: x"}) == "PARTIAL_FAILURE"
    assert overall_status({"a": "FAILED: y"}) == "FAILED"


def test_log_and_gates(spark, tmp_path):
    path = str(tmp_path / "log")
    for day, rows in (("2026-01-01", 100), ("2026-01-02", 95), ("2026-01-03", 80)):
        append_run(spark, path, "fact", day, "t", {"fact_orders": "SUCCESS"}, {"fact_orders": rows})
    assert [volume_status(spark, path, "fact_orders", rows) for rows in (72, 71)] == ["OK", "ANOMALY"]
    assert volume_status(spark, str(tmp_path / "none"), "fact_orders", 1) == "OK"
    runs = table_runs(read_log(spark, path), "fact_orders")
    gated = volume_gate(runs, "run_date", "rows").orderBy("run_date").collect()
    assert [(r.rows, r.status) for r in gated] == [(100, "OK"), (95, "OK"), (80, "ANOMALY")]
    line = spark.range(1).select(retention_gate(F.lit(100), F.lit(95)), retention_gate(F.lit(100), F.lit(94))).first()
    assert tuple(line) == ("OK", "FLAGGED")


def test_one_failing_source_leaves_the_others(spark, tmp_path):
    tables = Tables(spark, SF)

    def read(spec):
        if spec.name == "date_dim":
            raise RuntimeError("no connection")
        return tables.source(spec)

    run = Run(Lake(spark, str(tmp_path)), read, "2026-01-01", "t", RULES)
    done = run_daily(run)
    assert list(done) == ["ingest"]
    assert done["ingest"]["order_items"] == "SUCCESS" and done["ingest"]["date_dim"].startswith("FAILED: no connection")
    assert run.lake.exists(RAW, ITEMS) and not run.lake.exists(CLEAN, ITEMS)
    assert read_log(spark, f"{run.lake.root}/run_log").first().overall_status == "PARTIAL_FAILURE"
    with pytest.raises(RuntimeError, match="PARTIAL_FAILURE"):
        run_daily(run, strict=True)


def test_two_daily_runs_give_the_same_tables(spark, tmp_path):
    tables = Tables(spark, SF)
    lake = Lake(spark, str(tmp_path))
    results = []
    for day in ("2026-01-01", "2026-01-02"):
        run = Run(lake, tables.source, day, day, RULES)
        done = run_daily(run)
        assert all(status == "SUCCESS" for layer in done.values() for status in layer.values())
        results.append({name: lake.load(name).drop("gold_ingestion_ts") for name in SERVING_TABLES})
    for name in SERVING_TABLES:
        one, two = (r[name] for r in results)
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty(), name
    assert run.stage_counts[ITEMS]["rows_in"] == lake.read(RAW, ITEMS).count()
    # Cleaning reads the raw layer after its dedupe; both loads carry the later date.
    assert {r[0] for r in lake.read(RAW, ITEMS).select(F.col("ingestion_date")).distinct().collect()} == {"2026-01-02"}
    # The grid and its sums agree with the fact.
    clv, fact = lake.load("gold_clv_snapshot"), lake.load("fact_orders")
    revenue = fact.filter(~F.col("is_anonymous")).agg(F.sum("total_revenue")).first()[0]
    last = clv.agg(F.max("date_key")).first()[0]
    assert clv.filter(F.col("date_key") == F.lit(last)).agg(F.sum("cumulative_spend")).first()[0] == revenue
    assert clv.agg(F.sum("daily_revenue")).first()[0] == revenue
    monthly = lake.load("gold_sales_monthly").agg(F.sum("total_revenue")).first()[0]
    assert monthly == lake.load("gold_sales_weekly").agg(F.sum("total_revenue")).first()[0] == fact.agg(
        F.sum("total_revenue")).first()[0]


def test_jdbc_reads_are_split(spark):
    clauses = day_predicates("t", date(2023, 1, 1), date(2023, 1, 11), 5)
    assert clauses == [
        "t < '2023-01-01' OR t IS NULL", "t >= '2023-01-01' AND t < '2023-01-06'",
        "t >= '2023-01-06' AND t < '2023-01-11'", "t >= '2023-01-11'"]
    # Every row matches exactly one clause.
    days = spark.sql("SELECT cast(d AS string) AS t FROM (SELECT explode(sequence(DATE'2022-12-20', DATE'2023-01-20')) d)")
    days = days.unionByName(spark.createDataFrame([(None,)], "t string"))
    assert sum(days.filter(c).count() for c in clauses) == days.count()
    assert range_options("id", 0, 100, 8)["numPartitions"] == "8"
    with pytest.raises(ValueError, match="one task"):
        read_table(spark, "jdbc:x", "t", {})
