"""Shapes of the physical plans that decide whether a job scales."""

from __future__ import annotations

import re
from datetime import datetime

import pytest

from checks.registry import QUERIES, RULES, Tables, _stored
from ordermill.operators.merge import upsert
from ordermill.operators.order_statistics import rank_key, with_tile
from ordermill.plans import audits, reports
from ordermill.plans.churn import churn_indicators
from ordermill.plans.cleaning import clean_options, clean_order_items
from ordermill.plans.dimensions import dim_restaurant
from ordermill.plans.lifetime_value import clv_snapshot
from ordermill.plans.locations import location_perf
from ordermill.plans.loyalty import loyalty_comparison
from ordermill.plans.orders import fact_orders
from ordermill.plans.sales import sales_daily, sales_monthly, sales_weekly
from ordermill.schemas import ITEM_KEYS
from ordermill.session import use_checkpoint_folder
from ordermill.sources.sample_data import raw_order_items, whole_number
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("build", [
    lambda t: clean_order_items(t.raw_items, RULES),
    lambda t: clean_options(t.raw_options),
    lambda t: fact_orders(t.items, t.options),
    lambda t: churn_indicators(t.fact),
    lambda t: sales_daily(t.items),
    lambda t: sales_weekly(t.fact),
    lambda t: sales_monthly(t.fact),
    lambda t: loyalty_comparison(t.fact),
    lambda t: clv_snapshot(t.fact, t.customers, t.calendar),
    lambda t: upsert(t.raw_items, t.raw_items, ITEM_KEYS),
])
def test_no_nested_loops_and_no_single_task(tables, build):
    text = plan(build(tables))
    main = text.split("Subquer")[0]
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "SinglePartition" not in main
    assert "Python" not in text and "ArrowEval" not in text


def test_tiles_are_comparisons_not_windows(tables):
    tiled = with_tile(tables.customers, "tile", 5, rank_key(F.col("total_spend"), 2), "user_id")
    text = plan(tiled)
    assert "Window" not in text and "Exchange" not in text.split("Subquer")[0]


def test_the_dense_table_is_not_shuffled(tables):
    text = plan(clv_snapshot(tables.fact, tables.customers, tables.calendar))
    assert "Generate explode" in text
    # The intervals are dealt out below the explode; above it only the tier boundaries, a line per day, are broadcast.
    main = text.split("Subquer")[0]
    assert sorted(re.findall(r"Exchange \w+|BroadcastExchange", main)) == ["BroadcastExchange", "Exchange rangepartitioning"]
    assert main.index("Generate explode") < main.index("Exchange rangepartitioning")
    assert "Window" not in text


def test_lines_and_options_are_shuffled_once_for_the_fact(tables):
    text = plan(fact_orders(tables.items, tables.options))
    assert len(re.findall(r"Exchange \w+", text)) == 1 and "Join" not in text


def test_hot_keys_combine_before_the_shuffle(tables):
    for df in (churn_indicators(tables.fact), loyalty_comparison(tables.fact), clean_order_items(tables.raw_items, RULES)):
        text = plan(df)
        assert "partial_" in text and "Window" not in text


def test_counts_of_orders_need_no_expand(tables):
    assert "Expand" not in plan(sales_monthly(tables.fact))
    assert "Expand" not in plan(loyalty_comparison(tables.fact))
    assert "Expand" not in plan(location_perf(tables.fact))


def test_scans_are_pruned(spark, tables):
    text = plan(sales_monthly(tables.fact))
    assert "order_datetime" not in text and "item_count" not in text
    text = plan(clean_order_items(tables.raw_items, RULES))
    assert re.search(r"PushedFilters: \[[^\]]*ORDER_ID", text)
    text = plan(raw_order_items(spark, SF).select("ORDER_ID", "ITEM_PRICE"))
    assert "l_shipdate" not in text and "o_totalprice" not in text


@pytest.mark.parametrize("build", [lambda t: dim_restaurant(t.items), lambda t: sales_daily(t.items)])
def test_distinct_counts_do_not_multiply_rows(tables, build):
    text = plan(build(tables))
    assert "Expand" not in text
    assert tables.items.inputFiles()[0].rsplit("/", 1)[0] not in text  # the items are read before, once


@pytest.mark.parametrize("build", [
    lambda t: audits.order_frequency(t.raw_items),
    lambda t: audits.group_size_histogram(t.raw_items, ["ORDER_ID"], audits.ITEMS_PER_ORDER),
])
def test_shares_go_on_from_stored_counts(tables, build):
    text = plan(build(tables))
    assert "ORDER_ID" not in text and "USER_ID" not in text


def test_customer_days_are_written_out_for_the_readers_customer_and_day_only(tables):
    """The snapshot of the queries is a view: conditions reach the intervals, and nothing stores the dense rows."""
    text = plan(reports.trajectory(tables.clv, "7"))
    assert text.index("Generate explode") < text.index("Filter") and "EqualTo(user_id,7)" in text
    assert "explode(sequence" in text
    assert "explode(sequence" not in plan(QUERIES["rep_clv_kpis"](tables))


def test_figures_of_the_last_day_from_one_day(tables):
    assert QUERIES["rep_clv_kpis"](tables).collect() == reports.clv_kpis(tables.clv).collect()


def test_times_are_made_into_text_before_the_lines_join(spark):
    text = plan(raw_order_items(spark, SF))
    assert "date_format" in text and text.index("Join") < text.index("date_format")


def _own_tables(spark, folder: str) -> str:
    """Five lines of two orders: one of a test app, one too dear, one that comes twice."""
    line = (1, 2, 3, 1, 4.0, 10.5, 0.1, 0.02, "A", "F")
    tables = {
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
                     [line, line, (1, 97, *line[2:]), (2, 2, 3, 2, 4.0, 51.0, *line[6:]), (2, *line[1:])]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(key, 7, datetime(1997, 3, key), "1-URGENT") for key in (1, 2)]),
        "part": ("p_partkey bigint, p_type string, p_name string", [(2, "SOUP", "pea soup"), (97, "TEST", "test")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_clean_items_do_not_store_the_raw_items_and_read_them_if_stored(spark, tmp_path):
    use_checkpoint_folder(spark)

    def stored(tables) -> bool:
        return (spark.sparkContext.applicationId, tables.folder, "raw-items") in _stored

    alone = Tables(spark, _own_tables(spark, str(tmp_path / "alone")))
    got = sorted(map(repr, alone.items.collect()))
    assert len(got) == 2 and not stored(alone)
    after = Tables(spark, _own_tables(spark, str(tmp_path / "after")))
    assert after.raw_items.count() == 5 and stored(after)
    assert "Join" not in plan(clean_order_items(after._raw_items_once(), RULES))
    assert sorted(map(repr, after.items.collect())) == got


def test_whole_numbers_are_those_of_round_without_a_decimal(spark):
    values = [n + d for n in (0.0, 1.0, 5199.0, 2.0**51) for d in (0.0, 0.5, 0.4999999999, 0.25, 1.5, 0.9999999)]
    values += [0.49999999999999994, 2.0**53 + 2, 9e18, 1.005 * 100, 2.675 * 100]
    df = spark.createDataFrame([(v,) for v in [*values, *[-v for v in values], None]], "v double")
    wrong = df.filter(~whole_number(F.col("v")).eqNullSafe(F.round("v").cast("bigint")))
    assert wrong.collect() == [] and "round(" not in plan(df.select(whole_number(F.col("v"))))
