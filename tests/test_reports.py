from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from ordermill.operators.distribution import hash_sample
from ordermill.plans import audits, reports
from tests.rows import raw_item, raw_items, raw_option, raw_options


def rfm(spark):
    return spark.createDataFrame([
        ("a", True, 1, 5, D("10.00"), 5, 5, "VIP"), ("b", True, 3, 1, D("1.00"), 4, 1, "Regular"),
        ("c", False, 9, 2, D("2.00"), 1, 2, "Regular"), ("d", None, 20, 0, D("0.00"), 1, 1, "Churn Risk"),
    ], "user_id string, is_loyalty boolean, recency_days int, frequency bigint, monetary decimal(18,2), "
       "r_score int, f_score int, segment string")


def test_loyalty_views(spark):
    table = rfm(spark)
    assert [reports.loyalty_view(table, v).count() for v in ("All", "Loyalty only", "Non-Loyalty only")] == [4, 2, 1]
    line = reports.rfm_medians(table, "Loyalty only").first()
    assert (line.customers, line.median_frequency, line.median_monetary, line.median_recency) == (2, 3.0, 5.5, 2.0)
    assert reports.rfm_medians(table.limit(0)).first().asDict() == {
        "median_frequency": None, "median_monetary": None, "median_recency": None, "customers": 0}
    labels = {(r.segment, r.loyalty_label): r.customer_count for r in reports.segment_by_loyalty(table).collect()}
    assert labels[("Churn Risk", "Unknown")] == 1
    assert {r.segment: str(r.pct) for r in reports.segment_share(table).collect()} == {
        "VIP": "25.00", "Regular": "50.00", "Churn Risk": "25.00"}


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("user_id"))
    samples = [{r[0] for r in hash_sample(df.repartition(n), "user_id", 50).collect()} for n in (1, 7)]
    assert samples[0] == samples[1] and len(samples[0]) == 50
    assert {r[0] for r in hash_sample(df, "user_id", 50, seed=1).collect()} != samples[0]


def churn(spark):
    return spark.createDataFrame(
        [(f"u{i:03d}", i, "Inactive" if i > 60 else "At Risk" if i > 45 else "Active", 2 + i % 3, D(i % 7), None if i % 2 else D(i))
         for i in range(0, 300)],
        "user_id string, days_since_last_order int, churn_tag string, total_orders bigint, avg_gap_days decimal(18,2), "
        "spend_change_pct decimal(18,2)")


def test_churn_reports(spark):
    table = churn(spark)
    alerts = reports.churn_alerts(table).collect()
    assert len(alerts) == 200 and alerts[0].user_id == "u299" and {r.alert_count for r in alerts} == {254}
    assert [r.tag for r in reports.churn_tags(table).collect()] == ["Active", "At Risk", "Inactive"]
    active = reports.churn_breakdown(table).collect()[0]
    assert (active.customer_count, active.median_days_since_last, active.median_spend_change_pct) == (46, 22.5, 22.0)


def test_trends(spark):
    weekly = spark.createDataFrame(
        [(2023, 1, "R1", D("5"), 1), (2023, 1, "R2", D("6"), 2), (2023, 11, "R1", D("7"), 3)],
        "order_year int, order_week int, restaurant_id string, total_revenue decimal(18,2), order_count bigint")
    assert [tuple(r) for r in reports.sales_trend(weekly, "weekly").collect()] == [
        ("2023-W01", D("11.00"), 3), ("2023-W11", D("7.00"), 3)]
    assert [r.order_count for r in reports.sales_trend(weekly, "weekly", "R1").collect()] == [1, 3]


def test_option_text_and_short_ids(spark):
    options = spark.createDataFrame([("G" * 40, "x", 1, D("2"), D("2"))],
                                    "option_group_name string, option_name string, attach_count bigint, "
                                    "total_revenue decimal(18,2), avg_price decimal(18,2)")
    assert reports.top_options(options).first().option_display == "G" * 30 + " / x"


def test_lifetime_value_reports(spark):
    clv = spark.sql("""
        SELECT * FROM VALUES
          ('a', DATE'2023-01-01', CAST(4 AS DECIMAL(18,2)), CAST(4 AS DECIMAL(18,2)), 'Low'),
          ('a', DATE'2023-01-02', CAST(0 AS DECIMAL(18,2)), CAST(4 AS DECIMAL(18,2)), 'Low'),
          ('b', DATE'2023-01-02', CAST(9 AS DECIMAL(18,2)), CAST(9 AS DECIMAL(18,2)), 'High'),
          ('c', DATE'2023-01-02', CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), 'Pre-Activity')
        AS t(user_id, date_key, daily_revenue, cumulative_spend, clv_tier)""").withColumn(
        "snapshot_year", F.year("date_key"))
    by_day = reports.clv_by_day_of_rows(clv)
    assert [(r.date_key.day, r.clv_tier, r.customer_count, r.median_spend) for r in by_day.collect()] == [
        (1, "Low", 1, 4.0), (2, "High", 1, 9.0), (2, "Low", 1, 4.0)]
    assert reports.clv_by_day_of_rows(clv, approximate=True).count() == 3
    assert {r.clv_tier: r.date_key.day for r in reports.latest_tier_counts(by_day).collect()} == {"Low": 2, "High": 2}
    kpis = reports.clv_kpis(clv).first()
    assert (kpis.customers_scored, kpis.max_clv, kpis.median_clv_latest) == (3, D("9.00"), 4.0)
    assert [r.is_order_day for r in reports.trajectory(clv, "a").collect()] == [True, False]
    # An id is a value, never SQL text.
    assert reports.trajectory(clv, "' OR '1'='1").count() == 0


def test_audits(spark):
    items = raw_items(
        spark, raw_item(), raw_item(), raw_item(LINEITEM_ID="b", USER_ID="u2"), raw_item(LINEITEM_ID="c", USER_ID=None),
        raw_item(ORDER_ID="o2", LINEITEM_ID="d", ITEM_CATEGORY="", PRINTED_CARD_NUMBER="k"),
        raw_item(ORDER_ID="o3", LINEITEM_ID="e", USER_ID="u3", PRINTED_CARD_NUMBER="k"))
    spread = {r.column_name: r.violations for r in audits.dependency_audit(items, ["USER_ID", "RESTAURANT_ID"]).collect()}
    assert spread == {"USER_ID": 1, "RESTAURANT_ID": 0}
    assert tuple(audits.key_audit(items, ["ORDER_ID", "LINEITEM_ID"]).first()) == (6, 5, 1)
    assert audits.duplicate_rows(items).first().copies == 2
    profile = {r.column_name: r for r in audits.column_profile(items).collect()}
    assert (profile["ITEM_CATEGORY"].null_count, profile["ITEM_CATEGORY"].distinct_count) == (1, 1)
    assert (profile["USER_ID"].null_count, str(profile["USER_ID"].filled_pct), profile["USER_ID"].distinct_count) == (
        1, "83.33", 3)
    assert [tuple(r) for r in audits.shared_cards(items).collect()] == [("k", 2)]
    options = raw_options(spark, raw_option(), raw_option(LINEITEM_ID="gone"), raw_option(ORDER_ID="lost"))
    line = audits.orphan_audit(items, options).first()
    assert (line.orders_in_both, line.orders_without_options, line.option_orders_without_items,
            line.orphan_option_rows) == (1, 2, 1, 2)


def test_column_profile_repeats_no_rows_and_its_sketches_keep_their_bound(spark):
    df = spark.range(30_000).select(
        F.col("id"), (F.col("id") % 7).cast("string").alias("few"), F.when(F.col("id") % 2 == 0, "").alias("odd. name"),
        F.lit(None).cast("string").alias("none"))
    exact = {r["column_name"]: r for r in audits.column_profile(df).collect()}
    assert [exact[c]["distinct_count"] for c in df.columns] == [30_000, 7, 0, 0]
    assert [exact[c]["null_count"] for c in df.columns] == [0, 0, 30_000, 30_000]
    mixed = audits.column_profile(df, exact=["few"])
    for r in mixed.collect():
        wanted = exact[r["column_name"]]
        assert abs(r["distinct_count"] - wanted["distinct_count"]) <= audits.DISTINCT_ERROR * wanted["distinct_count"]
        assert (r["row_count"], r["filled_pct"]) == (wanted["row_count"], wanted["filled_pct"])
    plan = mixed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for node in plan.split("\n"):
        assert "Expand" not in node  # the one Generate writes the single line of totals out by column
    assert plan.count("Generate") == 1
    assert audits.column_profile(df.limit(0)).count() == 0


def test_orphans_shuffle_both_tables_once(spark):
    line = "ORDER_ID string, LINEITEM_ID string"
    items = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("c", None), (None, "1")], line)
    options = spark.createDataFrame(
        [("a", "1"), ("a", "1"), ("a", "2"), ("c", None), ("d", "1"), (None, "1"), (None, None)], line)
    audit = audits.orphan_audit(items, options)
    assert audit.collect() == [(3, 1, 1, 5)]
    assert audits.orphan_audit(items.limit(0), options.limit(0)).collect() == [(0, 0, 0, 0)]
    plan = audit._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    planned = audit._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert planned.count("Exchange hashpartitioning(") == 1
