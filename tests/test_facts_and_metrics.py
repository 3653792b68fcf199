from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal as D

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.plans.churn import churn_indicators
from ordermill.plans.cleaning import ItemRules, clean_options, clean_order_items
from ordermill.plans.dimensions import dim_customer, dim_date, dim_menu_item, dim_restaurant
from ordermill.plans.lifetime_value import clv_snapshot
from ordermill.plans.locations import location_perf
from ordermill.plans.loyalty import loyalty_comparison
from ordermill.plans.orders import fact_orders
from ordermill.plans.sales import sales_monthly, sales_weekly
from ordermill.plans.segments import rfm_base, rfm_segments
from ordermill.plans.upsell import upsell_summary
from ordermill.sources.holidays import holiday_rows, holidays_by_rule, us_holidays
from tests.rows import calendar, customers, fact, raw_item, raw_items, raw_option, raw_options

RULES = ItemRules(excluded_apps=("Test App",), excluded_restaurants=("R9",))


def test_fact(spark):
    items = clean_order_items(raw_items(
        spark, raw_item(LINEITEM_ID="a"), raw_item(LINEITEM_ID="b", IS_LOYALTY="FALSE", USER_ID=None),
        raw_item(ORDER_ID="o2", LINEITEM_ID="c", USER_ID=None, CREATION_TIME_UTC="2023-01-01T00:00:00Z"),
    ), RULES)
    options = clean_options(raw_options(
        spark, raw_option(LINEITEM_ID="a"), raw_option(LINEITEM_ID="a", OPTION_NAME="soy", OPTION_PRICE=D("0.50")),
        raw_option(LINEITEM_ID="a", OPTION_NAME="free", OPTION_PRICE=D("0")), raw_option(LINEITEM_ID="lost")))
    one, two = fact_orders(items, options).orderBy("order_id").collect()
    assert (one.user_id, one.item_count, one.total_item_revenue, one.total_option_revenue, one.total_revenue) == (
        "u1", 2, D("10.00"), D("1.50"), D("11.50"))
    assert (one.has_paid_options, one.paid_option_count, one.is_loyalty, one.is_anonymous) == (True, 2, True, False)
    assert (two.total_option_revenue, two.paid_option_count, two.has_paid_options, two.is_anonymous) == (
        D("0.00"), 0, False, True)
    assert (two.order_year, two.order_week, two.order_year_month) == (2023, 52, "2023-01")
    summary = upsell_summary(options, fact_orders(items, options)).first()
    # The lost option has no order, but it is an option that was sold.
    assert (summary.total_option_rows, summary.total_option_revenue, summary.order_upsell_rate_pct) == (
        4, D("2.50"), D("50.00"))


def test_fact_of_repeated_lines_and_missing_keys(spark):
    """Options count with each copy of their line, and a key with a NULL equals no line."""
    items = spark.createDataFrame(
        [("o1", "a", "u2", D("1.00"), None), ("o1", "a", "u1", D("2.00"), True), ("o1", None, None, D("4.00"), None),
         (None, "a", "u3", D("8.00"), False), (None, None, "u4", None, None)],
        "ORDER_ID string, LINEITEM_ID string, USER_ID string, line_item_revenue decimal(12,2), IS_LOYALTY boolean",
    ).withColumns({
        "APP_NAME": F.lit("Shop"), "RESTAURANT_ID": F.lit("R1"), "order_date": F.lit(date(2024, 1, 1)), "order_hour": F.lit(1),
        "CREATION_TIME_UTC": F.lit("2024-01-01 01:00:00").cast("timestamp")})
    options = spark.createDataFrame(
        [("o1", "a", D("0.50"), True), ("o1", "a", None, None), ("o1", None, D("0.25"), True), (None, "a", D("0.25"), True),
         ("o1", "lost", D("0.25"), True), ("o2", "a", D("0.25"), True)],
        "ORDER_ID string, LINEITEM_ID string, option_revenue decimal(12,2), is_paid_option boolean")
    got = fact_orders(items, options).orderBy("order_id").select(
        "order_id", "user_id", "item_count", "total_item_revenue", "total_option_revenue", "paid_option_count", "is_loyalty")
    assert [tuple(r) for r in got.collect()] == [
        (None, "u3", 1, D("8.00"), D("0.00"), 0, False), ("o1", "u1", 2, D("7.00"), D("1.00"), 2, True)]


def test_upsell_without_rows(spark):
    options = clean_options(raw_options(spark, raw_option())).limit(0)
    line = upsell_summary(options, fact(spark, ("o", "u", "2023-01-01", "1")).limit(0)).first()
    assert (line.total_option_rows, line.free_option_pct, line.upsell_share_of_revenue_pct,
            line.avg_option_revenue_per_upsell_order) == (0, None, D("0.00"), D("0.00"))


def test_dimensions(spark):
    rows = [
        raw_item(ORDER_ID="1", LINEITEM_ID="1", RESTAURANT_ID="R2", CREATION_TIME_UTC="2023-12-24T10:00:00Z"),
        raw_item(ORDER_ID="2", LINEITEM_ID="2", RESTAURANT_ID="R1", CREATION_TIME_UTC="2023-12-26T10:00:00Z",
                 IS_LOYALTY="FALSE"),
        raw_item(ORDER_ID="3", LINEITEM_ID="3", RESTAURANT_ID="R2", USER_ID=None, ITEM_NAME=None,
                 CREATION_TIME_UTC="2023-12-26T11:00:00Z"),
    ]
    items = clean_order_items(raw_items(spark, *rows), RULES)
    days = dim_date(items, us_holidays(spark)).collect()
    assert [(r.date_key.day, r.is_weekend, r.is_holiday, r.holiday_name) for r in days] == [
        (24, True, False, None), (25, False, True, "Christmas Day"), (26, False, False, None)]
    customer = dim_customer(items).first()
    # Equal visits at both locations: the smaller id.
    assert (customer.primary_restaurant_id, customer.tenure_days, customer.total_orders, customer.total_spend,
            customer.avg_order_value, customer.is_loyalty, customer.clv_tier) == (
        "R1", 2, 2, D("10.00"), D("5.00"), True, "Low")
    places = dim_restaurant(items).orderBy("revenue_rank").collect()
    assert [(r.restaurant_id, r.total_orders, r.unique_customers, r.active_days) for r in places] == [
        ("R2", 2, 1, 2), ("R1", 1, 1, 1)]
    menu = dim_menu_item(items).collect()
    assert [(r.item_name, r.total_orders_sold, r.total_quantity_sold, r.avg_price) for r in menu] == [
        ("Soup", 2, 2, D("5.00"))]


def test_holidays_are_fixed():
    rows = holiday_rows()
    listed = [r for r in rows if r[0].year < 2025]
    assert len(listed) == 54 and listed[0][0] == date(2020, 1, 1) and listed[-1][0] == date(2024, 12, 25)
    assert [d for d, _ in rows] == sorted({d for d, _ in rows})


def test_later_holidays_follow_the_rule():
    rows = dict(holiday_rows())
    assert [d.isoformat() for d in rows if d.year == 2026] == [
        "2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19", "2026-07-03", "2026-09-07", "2026-10-12",
        "2026-11-11", "2026-11-26", "2026-12-25"]
    assert rows[date(2026, 7, 3)] == "Independence Day (Observed)"
    # The rule gives the listed days of a year in which none falls on a week-end.
    assert holidays_by_rule(2024) == [(d, n) for d, n in holiday_rows() if d.year == 2024]


def dense_brute_force(orders: pd.DataFrame, first_days: dict[str, date], last: date) -> dict:
    """Every customer and day by plain loops, tiers by sorting each day."""
    rows = {}
    for user, first in first_days.items():
        spend, count, day = 0, 0, first
        while day <= last:
            today = orders[(orders.user == user) & (orders.day == day)]
            spend, count = spend + int(today.cents.sum()), count + len(today)
            rows[user, day] = [int(today.cents.sum()), len(today), spend, count, (day - first).days]
            day += timedelta(days=1)
    for day in {d for _, d in rows}:
        ranked = sorted((r[2], u) for (u, d), r in rows.items() if d == day)
        size, larger = divmod(len(ranked), 5)
        for i, (spend, user) in enumerate(ranked):
            edge = larger * (size + 1)
            tile = i // (size + 1) + 1 if i < edge else larger + (i - edge) // size + 1
            label = "Pre-Activity" if spend == 0 else {5: "High", 1: "Low"}.get(tile, "Medium")
            rows[user, day].append(label)
    return rows


def test_lifetime_value_against_loops(spark):
    start = date(2023, 1, 1)
    lines = []
    for i in range(60):
        # One customer has a third of all orders; several spend the same.
        user = "hot" if i % 3 == 0 else f"u{i % 11}"
        cents = 0 if i % 13 == 0 else (i % 4) * 250
        lines.append((f"o{i}", user, (start + timedelta(days=(i * 7) % 40)).isoformat(), str(D(cents) / 100)))
    lines.append(("late", None, "2023-02-20", "5.00"))
    orders = fact(spark, *lines)
    frame = pd.DataFrame(
        [(u, date.fromisoformat(d), int(D(v) * 100)) for _, u, d, v in lines if u], columns=["user", "day", "cents"])
    first_days = frame.groupby("user").day.min().to_dict()
    people = customers(spark, *[(u, d.isoformat(), False) for u, d in first_days.items()])
    got = clv_snapshot(orders, people, calendar(spark, "2023-01-01", "2023-02-20")).collect()
    wanted = dense_brute_force(frame, first_days, date(2023, 2, 20))
    assert len(got) == len(wanted)
    assert {
        (r.user_id, r.date_key): [int(r.daily_revenue * 100), r.daily_order_count, int(r.cumulative_spend * 100),
                                  r.cumulative_orders, r.days_since_first_order, r.clv_tier] for r in got} == wanted
    assert all(r.is_active_day == (r.daily_revenue > 0) and r.snapshot_year == 2023 for r in got)


def test_customer_days_follow_the_dimension(spark):
    """A first day without an order still starts the series; orders before it or of strangers do not count."""
    orders = fact(spark, ("1", "a", "2023-01-01", "4"), ("2", "a", "2023-01-05", "6"), ("3", "x", "2023-01-02", "9"))
    got = clv_snapshot(orders, customers(spark, ("a", "2023-01-03", True)), calendar(spark, "2023-01-01", "2023-01-06"))
    assert [(r.date_key.day, int(r.cumulative_spend), r.clv_tier) for r in got.orderBy("date_key").collect()] == [
        (3, 0, "Pre-Activity"), (4, 0, "Pre-Activity"), (5, 6, "Low"), (6, 6, "Low")]


def test_rfm_window_edges(spark):
    ref = date(2023, 12, 31)
    days = {"in": ref - timedelta(days=365), "out": ref - timedelta(days=366), "now": ref}
    orders = fact(spark, *[(f"o{u}", u, d.isoformat(), "7") for u, d in days.items()])
    people = customers(spark, *[(u, d.isoformat(), None) for u, d in days.items()], ("none", "2023-01-01", True))
    base = {r.user_id: (r.recency_days, r.frequency, r.monetary) for r in rfm_base(orders, people).collect()}
    assert base == {"in": (365, 1, D("7.00")), "out": (366, 0, D("0.00")), "now": (0, 1, D("7.00")),
                    "none": (None, 0, D("0.00"))}
    scores = {r.user_id: r.rfm_score for r in rfm_segments(orders, people).collect()}
    # Recency from oldest to newest, then customers without any order.
    assert {u: s[0] for u, s in scores.items()} == {"out": "1", "in": "2", "now": "3", "none": "4"}


def churn_by_windows(orders):
    """The same indicators with row numbers per customer."""
    w = Window.partitionBy("user_id")
    ranked = orders.filter("user_id IS NOT NULL").withColumns({
        "rn": F.row_number().over(w.orderBy("order_date", "order_datetime", "order_id")), "n": F.count("*").over(w)})
    return {r.user_id: (r.recent, r.prior) for r in ranked.groupBy("user_id").agg(
        F.sum(F.when(F.col("rn") == F.col("n"), F.col("total_revenue"))).alias("recent"),
        F.round(F.avg(F.when(F.col("rn") < F.col("n"), F.col("total_revenue"))), 2).alias("prior")).collect()}


def test_churn(spark):
    lines = [("a1", "once", "2023-03-01", "5"), ("b1", "twice", "2023-01-01", "10"), ("b2", "twice", "2023-01-31", "15"),
             ("c1", "sameday", "2023-03-01", "0"), ("c2", "sameday", "2023-03-01", "8"), ("z", None, "2023-12-01", "1")]
    lines += [(f"h{i}", "hot", f"2023-02-{i % 28 + 1:02d}", f"{i}.35") for i in range(200)]
    orders = fact(spark, *lines)
    got = {r.user_id: r for r in churn_indicators(orders).collect()}
    assert set(got) == {"twice", "sameday", "hot"}
    twice, same = got["twice"], got["sameday"]
    assert (twice.days_since_last_order, twice.churn_tag, twice.avg_gap_days, twice.churn_tag_personal) == (
        29, "Active", D("30.00"), "Active")
    assert (twice.recent_spend, twice.prior_avg_spend, twice.spend_change_pct) == (D("15.00"), D("10.00"), D("50.00"))
    assert (same.avg_gap_days, same.prior_avg_spend, same.spend_change_pct, same.churn_tag_personal) == (
        D("0.00"), D("0.00"), None, "Active")
    wanted = churn_by_windows(orders)
    assert all((r.recent_spend, r.prior_avg_spend) == wanted[u] for u, r in got.items())


def test_loyalty_counts_a_customer_in_both_segments(spark):
    orders = fact(
        spark, ("1", "a", "2023-01-01", "10", True, "R1", 1), ("2", "a", "2023-01-02", "20", False),
        ("3", "a", "2023-01-03", "30", False), ("4", "b", "2023-01-03", "5", None), ("5", None, "2023-01-03", "7"))
    got = {r.segment: r for r in loyalty_comparison(orders).collect()}
    assert [got[s].customer_count for s in ("Loyalty", "Non-Loyalty", "Anonymous")] == [1, 2, 0]
    other, nobody = got["Non-Loyalty"], got["Anonymous"]
    assert (other.order_count, other.total_revenue, other.avg_orders_per_customer, other.avg_customer_spend,
            other.repeat_customer_rate_pct) == (3, D("55.00"), D("1.50"), D("27.50"), D("50.00"))
    assert (nobody.order_count, nobody.avg_spend_per_order, nobody.avg_customer_spend,
            nobody.repeat_customer_rate_pct) == (1, D("7.00"), None, None)
    assert got["Loyalty"].option_attach_rate_pct == D("100.00")


def test_locations(spark):
    orders = fact(
        spark, ("1", "a", "2023-01-01", "10", True, "R1"), ("2", "a", "2023-12-30", "20", False, "R1"),
        ("3", "b", "2023-02-01", "30", False, "R1"), ("4", None, "2023-02-01", "60", False, "R2"))
    one, two = location_perf(orders).orderBy("restaurant_id").collect()
    # 1 January and 30 December carry the same year and ISO week.
    assert (one.active_weeks, one.orders_per_week, one.repeat_customer_count, one.retention_rate_pct) == (
        2, D("1.50"), 1, D("50.00"))
    assert (two.unique_customers, two.repeat_customer_count, two.retention_rate_pct) == (0, None, None)
    # Equal revenue: the smaller id first.
    assert [(r.revenue_rank, r.orders_rank, r.customers_rank) for r in (one, two)] == [(1, 1, 1), (2, 2, 2)]


def test_weeks_by_iso_year(spark):
    orders = fact(spark, ("1", "a", "2023-01-01", "10"), ("2", "a", "2023-12-30", "20"))
    assert [(r.order_year, r.order_week, r.order_count) for r in sales_weekly(orders).collect()] == [(2023, 52, 2)]
    by_iso = sorted((r.order_year, r.order_count) for r in sales_weekly(orders, by_iso_year=True).collect())
    assert by_iso == [(2022, 1), (2023, 1)]
    totals = sum(r.total_revenue for r in sales_monthly(orders).collect())
    assert totals == D("30.00")
