"""Ranks on intervals against rows written out day by day, and what the lifetime value jobs make of them."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import date, timedelta
from statistics import quantiles

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.registry import Tables
from ordermill.functions.numbers import magnitude_bucket
from ordermill.operators.interval_statistics import Intervals, day_histogram, interval_tile_cuts, interval_values_at
from ordermill.plans import lifetime_value
from ordermill.plans.lifetime_value import clv_daily_stats, clv_snapshot, stored_intervals
from ordermill.plans.lifetime_value_ranked import clv_by_percent_rank
from ordermill.plans.reports import clv_by_day, clv_by_day_of_rows

SF = "/root/testdata/sf0.001"
START = date(2024, 2, 25)
SPAN = st.tuples(st.integers(0, 12), st.integers(-2, 9), st.sampled_from([-500, 0, 0, 1, 7, 100, 101, 10**9]))


def stored(spark, spans, bits=2):
    rows = [(f"u{i:03d}", START + timedelta(a), START + timedelta(a + n), key) for i, (a, n, key) in enumerate(spans)]
    df = spark.createDataFrame(rows, "id string, first date, until date, key bigint")
    return Intervals(df.withColumn("bucket", magnitude_bucket(F.col("key"), bits)), "first", "until", "key", "bucket", "id"), rows


def by_day(rows):
    days = defaultdict(list)
    for name, first, until, key in rows:
        for n in range((until - first).days + 1):
            days[first + timedelta(n)].append((key, name))
    return {day: sorted(found) for day, found in days.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(SPAN, min_size=1, max_size=40))
def test_tiles_and_values_of_every_day(spark, spans):
    intervals, rows = stored(spark, spans)
    days = by_day(rows)
    counts = {(r["d"]): r["n"] for r in day_histogram(intervals, "d").groupBy("d").agg(F.sum("_count").alias("n")).collect()}
    assert counts == {day: len(found) for day, found in days.items()}

    cuts = {r["d"]: r for r in interval_tile_cuts(intervals, 3, "d").collect()}
    for day, found in days.items():
        size, larger = divmod(len(found), 3)
        for tile in (2, 3):
            at = (tile - 1) * size + min(tile - 1, larger)
            if at < len(found):
                assert tuple(cuts[day][f"_cut_{tile}"]) == found[at]
            else:
                assert day not in cuts or cuts[day][f"_cut_{tile}"] is None

    ranks = {"least": F.lit(0), "second": F.lit(1), "after_none": F.col("_none"), "last": F.col("_n") - 1}
    none = F.col("_bucket") <= magnitude_bucket(F.lit(0).cast("bigint"), 2)
    values = {r["d"]: r for r in interval_values_at(intervals, "d", ranks, {"_none": none}).collect()}
    assert set(values) == set(days)
    for day, found in days.items():
        keys = [key for key, _ in found]
        unspent = sum(key <= 0 for key in keys)
        line = values[day]
        assert (line["_n"], line["_none"], line["least"], line["last"]) == (len(keys), unspent, keys[0], keys[-1])
        assert line["second"] == (keys[1] if len(keys) > 1 else None)
        assert line["after_none"] == (keys[unspent] if unspent < len(keys) else None)


def test_one_value_of_most_rows(spark):
    spans = [(0, 5, 700)] * 300 + [(i % 3, 4, 650 + i) for i in range(150)]
    intervals, rows = stored(spark, spans)
    cuts = {r["d"]: r for r in interval_tile_cuts(intervals, 5, "d").collect()}
    for day, found in by_day(rows).items():
        size, larger = divmod(len(found), 5)
        assert [tuple(cuts[day][f"_cut_{t}"]) for t in range(2, 6)] == [
            found[(t - 1) * size + min(t - 1, larger)] for t in range(2, 6)]


def test_no_intervals(spark):
    intervals, _ = stored(spark, [(0, -1, 5)])
    assert interval_tile_cuts(intervals, 5, "d").count() == 0
    assert interval_values_at(intervals, "d", {"least": F.lit(0)}).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def test_daily_statistics_equal_those_of_the_rows(tables):
    rows = {(r.date_key, r.clv_tier): tuple(r) for r in clv_by_day_of_rows(tables.clv).collect()}
    stats = {(r.date_key, r.clv_tier): tuple(r) for r in clv_by_day(tables.clv_stats).collect()}
    assert rows == stats and len(stats) > 1000
    assert "gold_ingestion_ts" in clv_daily_stats(tables.fact, tables.customers, tables.calendar, "now").columns


def test_customers_without_spend_are_no_tier(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 5)], "date_key date")
    people = spark.createDataFrame([(f"u{i}", date(2024, 1, 1)) for i in range(9)], "user_id string, first_order_date date")
    fact = spark.createDataFrame(
        [(f"u{i}", date(2024, 1, 2), i, False) for i in range(3, 9)], "user_id string, order_date date, total_revenue int, is_anonymous boolean")
    fact = fact.withColumn("total_revenue", F.col("total_revenue").cast("decimal(18,2)"))
    got = {(r.date_key.day, r.clv_tier): tuple(r)[2:] for r in clv_daily_stats(fact, people, days).collect()}
    # From the second day on u0 to u2 have spent nothing and fill the lowest tile of two and one place above it.
    medium, high = [3.0, 4.0, 5.0, 6.0, 7.0], [8.0]
    q = [float(x) for x in quantiles(medium, n=4, method="inclusive")]
    for day in (2, 3, 4):
        assert got[day, "Medium"] == (5, *q) and got[day, "High"] == (1, *(high * 3))
    assert set(got) == {(d, t) for d in (2, 3, 4) for t in ("Medium", "High")}


def test_days_are_written_out_once(tables, monkeypatch):
    """Only the result expands all intervals; boundaries, limits and statistics expand runs of wanted days."""
    expanded = []
    real = lifetime_value.expand_days
    monkeypatch.setattr(lifetime_value, "expand_days", lambda *a: expanded.append(a) or real(*a))
    intervals = stored_intervals(tables.fact, tables.customers, tables.calendar)
    clv_daily_stats(tables.fact, tables.customers, tables.calendar, intervals=intervals)
    assert not expanded
    for df in (clv_snapshot(tables.fact, tables.customers, tables.calendar, intervals=intervals),
               clv_by_percent_rank(tables.fact, tables.customers, tables.calendar)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Generate explode", text.split("Subquer")[0])) == 1
    assert len(expanded) == 2


def test_customer_days_dealt_out_by_days_are_the_same(tables):
    """Pieces of intervals expand to the same rows; most tasks have too few days for an aggregate of sketches to sort its rows."""
    intervals = stored_intervals(tables.fact, tables.customers, tables.calendar)
    plain, by_days = intervals.expanded(), intervals.expanded(by_days=True)
    columns = [c for c in plain.columns if c != "until"]  # a piece ends where the next begins
    plain, narrow = plain.select(*columns), by_days.select(*columns)
    assert plain.exceptAll(narrow).isEmpty() and narrow.exceptAll(plain).isEmpty()
    # Ranges are of equal rows, so only those of the thin first days are longer than two pieces.
    per_task = by_days.groupBy(F.spark_partition_id()).agg(F.count_distinct("date_key").alias("days"))
    assert per_task.agg(F.median("days")).first()[0] <= 2 * lifetime_value.DAYS_PER_PIECE
    last = tables.calendar.agg(F.max("date_key")).scalar()
    only = intervals.expanded(only=last).select(*columns)
    assert only.count() == plain.filter(F.col("date_key") == last).count() > 0
    assert only.exceptAll(plain).isEmpty()


def test_spans_stand_for_the_customer_days(tables):
    """Written out day by day they are the same rows; most days come as parts of longer spans, each within a month."""
    spans = tables.spend_intervals.spans(tables.spend_cuts)
    last = F.date_add("date_key", (F.col("days") - 1).cast("int"))
    assert spans.filter(F.trunc("date_key", "MM") != F.trunc(last, "MM")).isEmpty()
    days = spans.select(F.explode(F.sequence("date_key", last)).alias("date_key"), "clv_tier", "cumulative_spend")
    rows = tables.clv.select(*days.columns)
    assert days.exceptAll(rows).isEmpty() and rows.exceptAll(days).isEmpty()
    assert spans.count() < rows.count() / 3


def test_spans_where_a_tier_is_missing_on_some_days(spark):
    """One customer, then two, then six: boundaries come up within half a month, and no tier is carried past them."""
    people = spark.createDataFrame(
        [(f"u{i}", date(2024, 1, d)) for i, d in enumerate((1, 5, 9, 9, 20, 20))], "user_id string, first_order_date date")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-03-31')) AS date_key")
    fact = people.select(
        "user_id", F.col("first_order_date").alias("order_date"), F.lit(5).cast("decimal(18,2)").alias("total_revenue"),
        F.lit(False).alias("is_anonymous"))
    intervals = stored_intervals(fact, people, days)
    cuts = lifetime_value.spend_cuts(intervals)
    spans = intervals.spans(cuts)
    last = F.date_add("date_key", (F.col("days") - 1).cast("int"))
    got = spans.select(F.explode(F.sequence("date_key", last)).alias("date_key"), "clv_tier", "cumulative_spend")
    rows = clv_snapshot(fact, people, days, intervals=intervals, cuts=cuts).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect())) and spans.count() < rows.count()


def test_percent_ranks_use_stored_intervals_and_their_key(tables, monkeypatch):
    def refuse(*_):
        raise AssertionError("built again")

    intervals = tables.spend_intervals
    monkeypatch.setattr("ordermill.plans.lifetime_value_ranked.stored_intervals", refuse)
    ranked = clv_by_percent_rank(tables.fact, tables.customers, tables.calendar, intervals, keyed=True)
    assert ranked.filter(F.col("spend_key") != (F.col("cumulative_spend") * 100).cast("bigint")).count() == 0
    assert ranked.drop("spend_key").columns[-1] == "is_active"
