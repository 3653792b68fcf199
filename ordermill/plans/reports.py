"""Reports on the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import CHURN_ORDER, SEGMENT_ORDER, SPEND_TIERS, loyalty_label, position_in
from ordermill.functions.numbers import integer_key, money_percent, percent, ratio
from ordermill.operators.distribution import count_and_share, hash_sample
from ordermill.operators.order_statistics import group_quantiles
from ordermill.plans.lifetime_value import QUARTILES
from ordermill.schemas import money

# Sizes and limits of the lists shown.
ALERT_DAYS, ALERT_ROWS = 45, 200
TOP_CATEGORIES, TOP_CUSTOMERS, TOP_OPTIONS, PLOTTED_OPTIONS = 20, 50, 15, 100
SEGMENT_SAMPLE, CHURN_SAMPLE = 5000, 3000


def business_kpis(loyalty: DataFrame, upsell: DataFrame) -> DataFrame:
    """Revenue, orders, known customers, loyalty share and upsell share.

    A customer in both known segments counts twice, as in the comparison table.
    """
    known = F.col("segment") != "Anonymous"
    customers = F.coalesce(F.sum(F.when(known, F.col("customer_count"))), F.lit(0))
    loyal = F.coalesce(F.sum(F.when(F.col("segment") == "Loyalty", F.col("customer_count"))), F.lit(0))
    return loyalty.agg(
        money(F.sum("total_revenue")).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        customers.alias("total_customers"),
        F.coalesce(percent(loyal, customers), F.lit(0)).alias("loyalty_pct"),
    ).withColumn("upsell_share_pct", upsell.select("upsell_share_of_revenue_pct").scalar())


def distinct_customer_kpis(fact: DataFrame) -> DataFrame:
    """Known customers and those ever loyal, each counted once."""
    per_user = fact.filter(~F.col("is_anonymous")).groupBy("user_id").agg(F.bool_or("is_loyalty").alias("loyal"))
    return per_user.agg(
        F.count("*").alias("total_customers"),
        F.count_if("loyal").alias("loyalty_customers"),
        percent(F.count_if("loyal"), F.count("*")).alias("loyalty_pct"),
    )


# Lifetime value -----------------------------------------------------------

def clv_by_day(stats: DataFrame) -> DataFrame:
    """Customers and quartiles of running spend per day and tier, from the stored daily statistics."""
    return stats.select("date_key", "clv_tier", "customer_count", *QUARTILES).orderBy("date_key", "clv_tier")


def clv_by_day_of_rows(clv: DataFrame, approximate: bool = False) -> DataFrame:
    """The same from customer-days, exact or sketched, for any choice of customers."""
    tiered = clv.filter(F.col("clv_tier").isin(*SPEND_TIERS))
    keys = ["date_key", "clv_tier"]
    spend = F.col("cumulative_spend")
    if approximate:
        count = F.count("*").alias("customer_count")
        sketched = [F.percentile_approx(spend, p).alias(name) for name, p in QUARTILES.items()]
        return tiered.groupBy(*keys).agg(count, *sketched).orderBy(*keys)
    return group_quantiles(tiered, keys, spend, QUARTILES, scale=2, count_name="customer_count").orderBy(*keys)


def latest_tier_counts(by_day: DataFrame) -> DataFrame:
    """Customers per tier on the last day the tier appears."""
    return by_day.groupBy("clv_tier").agg(
        F.max("date_key").alias("date_key"), F.max_by("customer_count", "date_key").alias("customer_count"))


def clv_kpis(clv: DataFrame, span: tuple[Column, Column] | None = None) -> DataFrame:
    """Customers scored, first and last day, greatest running spend, and its median on the last day.

    Every customer has a row on the last day, and running spend never falls, so that day has all but the
    first day; of the stored table only the first and the last year are read.  Where ``span`` names the
    first and the last day, as scalars, no other day is looked for.
    """
    def day_of(year: Column, pick) -> Column:
        return clv.filter(F.col("snapshot_year") == year).agg(pick("date_key")).scalar()

    if span is None:
        first_year, last_year = (clv.agg(pick("snapshot_year")).scalar() for pick in (F.min, F.max))
        first_day, last_day = day_of(first_year, F.min), day_of(last_year, F.max)
        latest = clv.filter((F.col("snapshot_year") == last_year) & (F.col("date_key") == last_day))
    else:
        first_day, last_day = span
        latest = clv.filter(F.col("date_key") == last_day)
    median = group_quantiles(latest, [], F.col("cumulative_spend"), {"median": 0.5}, scale=2)
    return latest.agg(
        F.count("*").alias("customers_scored"),
        F.max("date_key").alias("latest_date"),
        F.max("cumulative_spend").alias("max_clv"),
    ).select(
        "customers_scored", first_day.alias("earliest_date"), "latest_date", "max_clv",
        median.select("median").scalar().alias("median_clv_latest"))


def top_customers(customers: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    return customers.select("user_id", "total_spend", "total_orders", "clv_tier", "tenure_days").orderBy(
        F.desc("total_spend"), "user_id").limit(n)


def customer_profile(customers: DataFrame, user_id: Column | str) -> DataFrame:
    wanted = F.lit(user_id) if isinstance(user_id, str) else user_id
    return customers.filter(F.col("user_id") == wanted)


def trajectory(clv: DataFrame, user_id: Column | str) -> DataFrame:
    """Running spend of one customer by day; ``is_order_day`` marks days with revenue."""
    wanted = F.lit(user_id) if isinstance(user_id, str) else user_id
    return clv.filter(F.col("user_id") == wanted).select(
        "date_key", "cumulative_spend", "daily_revenue", "clv_tier",
        (F.col("daily_revenue") > 0).alias("is_order_day"),
    ).orderBy("date_key")


# Segments -----------------------------------------------------------------

def loyalty_view(rfm: DataFrame, view: str = "All") -> DataFrame:
    """Customers of one view: All, Loyalty only or Non-Loyalty only."""
    if view == "All":
        return rfm
    wanted = {"Loyalty only": True, "Non-Loyalty only": False}[view]
    return rfm.filter(F.col("is_loyalty") == wanted)


def _medians(df: DataFrame, keys: list[str], columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Median columns per key: name to (source column, decimals).

    The columns are put below each other first, so that all medians come from
    one table of frequencies: days and orders have few values, and of amounts
    there is one a customer.
    """
    cells = F.array(*[
        F.struct(F.lit(name).alias("_measure"), integer_key(F.col(source), scale).alias("_value"))
        for name, (source, scale) in columns.items()
    ])
    long = df.select(*keys, F.inline(cells))
    medians = group_quantiles(long, [*keys, "_measure"], F.col("_value"), {"_median": 0.5}, counted=True)
    return medians.groupBy(*keys).agg(*[
        (F.max(F.when(F.col("_measure") == name, F.col("_median"))) / F.lit(float(10**scale))).alias(name)
        for name, (_, scale) in columns.items()
    ])


def rfm_medians(rfm: DataFrame, view: str = "All") -> DataFrame:
    chosen = loyalty_view(rfm, view)
    medians = _medians(chosen, [], {
        "median_frequency": ("frequency", 0), "median_monetary": ("monetary", 2), "median_recency": ("recency_days", 0),
    })
    return medians.withColumn("customers", chosen.agg(F.count("*")).scalar())


def segment_by_loyalty(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment", loyalty_label(F.col("is_loyalty")).alias("loyalty_label")).agg(
        F.count("user_id").alias("customer_count"))


def segment_share(rfm: DataFrame, view: str = "All") -> DataFrame:
    return count_and_share(loyalty_view(rfm, view), ["segment"], "customer_count", 1)


def segment_sample(rfm: DataFrame, view: str = "All", size: int = SEGMENT_SAMPLE) -> DataFrame:
    return hash_sample(loyalty_view(rfm, view), "user_id", size)


def score_heat(rfm: DataFrame, view: str = "All") -> DataFrame:
    return loyalty_view(rfm, view).groupBy("r_score", "f_score").agg(F.count("user_id").alias("customer_count"))


def segment_leaderboard(rfm: DataFrame) -> DataFrame:
    """Counts, medians and spend per segment and loyalty."""
    labelled = rfm.withColumn("loyalty_label", loyalty_label(F.col("is_loyalty")))
    keys = ["segment", "loyalty_label"]
    totals = labelled.groupBy(*keys).agg(
        F.count("user_id").alias("customer_count"), money(F.sum("monetary")).alias("total_monetary"))
    medians = _medians(labelled, keys, {
        "median_recency": ("recency_days", 0), "median_frequency": ("frequency", 0), "median_monetary": ("monetary", 2),
    })
    return totals.join(medians, keys).orderBy(*keys)


# Churn --------------------------------------------------------------------

def churn_tags(churn: DataFrame, column: str = "churn_tag") -> DataFrame:
    """Customers per tag in the order of the tags, with percent."""
    tags = count_and_share(churn, [column], "customer_count", 1).withColumnRenamed(column, "tag")
    return tags.orderBy(position_in(F.col("tag"), CHURN_ORDER))


def churn_tags_both(churn: DataFrame) -> DataFrame:
    """Both tagging methods below each other, from one scan."""
    methods = F.array(*[
        F.struct(F.lit(c).alias("method"), F.col(c).alias("tag")) for c in ("churn_tag", "churn_tag_personal")
    ])
    counts = churn.select(F.inline(methods)).groupBy("method", "tag").agg(F.count("*").alias("customer_count"))
    return counts.withColumn("pct", percent(F.col("customer_count"), churn.agg(F.count("*")).scalar())).orderBy(
        "method", position_in(F.col("tag"), CHURN_ORDER))


def churn_sample(churn: DataFrame, size: int = CHURN_SAMPLE) -> DataFrame:
    return hash_sample(churn.dropna(subset=["spend_change_pct"]), "user_id", size)


def churn_breakdown(churn: DataFrame, column: str = "churn_tag") -> DataFrame:
    """Customers and four medians per tag; customers without a spend change do not count in its median."""
    medians = _medians(churn, [column], {
        "median_days_since_last": ("days_since_last_order", 0), "median_avg_gap": ("avg_gap_days", 2),
        "median_orders": ("total_orders", 0), "median_spend_change_pct": ("spend_change_pct", 2),
    })
    counts = churn.groupBy(column).agg(F.count("user_id").alias("customer_count"))
    return counts.join(medians, column).orderBy(position_in(F.col(column), CHURN_ORDER))


def churn_alerts(churn: DataFrame, days: int = ALERT_DAYS, n: int = ALERT_ROWS) -> DataFrame:
    """The ``n`` customers absent longest, with the number of all who are absent over ``days`` days."""
    absent = churn.filter(F.col("days_since_last_order") > days)
    listed = absent.orderBy(F.desc("days_since_last_order"), "user_id").limit(n)
    return listed.withColumn("alert_count", absent.agg(F.count("*")).scalar())


# Sales --------------------------------------------------------------------

def sales_kpis(monthly: DataFrame) -> DataFrame:
    return monthly.agg(
        money(F.sum("total_revenue")).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        F.count_distinct("order_year", "order_month").alias("months_observed"),
    )


def restaurants(monthly: DataFrame) -> DataFrame:
    """Sorted choices of the location filter."""
    return monthly.select("restaurant_id").distinct().orderBy("restaurant_id")


def sales_trend(sales: DataFrame, grain: str, restaurant_id: str | None = None) -> DataFrame:
    """Revenue and orders per period of a monthly, weekly or daily sales table, of one or all locations."""
    if restaurant_id is not None:
        sales = sales.filter(F.col("restaurant_id") == F.lit(restaurant_id))
    label, revenue = {
        "monthly": (F.col("order_year_month"), "total_revenue"),
        "weekly": (F.format_string("%d-W%02d", "order_year", "order_week"), "total_revenue"),
        "daily": (F.col("order_date").cast("string"), "total_item_revenue"),
    }[grain]
    return sales.groupBy(label.alias("period")).agg(
        money(F.sum(revenue)).alias("total_revenue"), F.sum("order_count").alias("order_count")).orderBy("period")


def top_categories(daily: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    return daily.groupBy("item_category").agg(
        money(F.sum("total_item_revenue")).alias("total_revenue"), F.sum("order_count").alias("order_count"),
    ).orderBy(F.desc("total_revenue"), "item_category").limit(n)


# Loyalty, locations, upsell ------------------------------------------------

def loyalty_report(loyalty: DataFrame) -> DataFrame:
    """Comparison in display order, with revenue shares and the repeat-rate lead over other known customers."""
    total = loyalty.agg(F.sum("total_revenue")).scalar()
    rate = F.col("repeat_customer_rate_pct")
    loyal, other = (F.max(F.when(F.col("segment") == s, rate)) for s in SEGMENT_ORDER[:2])
    gap = loyalty.agg((loyal - other).cast("decimal(18,2)")).scalar()
    return loyalty.withColumns({
        "revenue_share_pct": money_percent(F.col("total_revenue"), total),
        "repeat_rate_gap": gap,
        "position": position_in(F.col("segment"), SEGMENT_ORDER),
    }).orderBy("position")


def location_leaderboard(locations: DataFrame) -> DataFrame:
    """Locations by revenue rank, each with its share of all revenue and a short id."""
    total = locations.agg(F.sum("total_revenue")).scalar()
    return locations.select(
        "revenue_rank", F.right("restaurant_id", F.lit(8)).alias("restaurant_short"), "restaurant_id",
        "total_revenue", money_percent(F.col("total_revenue"), total).alias("revenue_share_pct"),
        "total_orders", "unique_customers", "repeat_customer_count", "retention_rate_pct",
        "avg_order_value", "orders_per_week", "loyalty_order_pct",
    ).orderBy("revenue_rank")


def location_kpis(locations: DataFrame) -> DataFrame:
    top = F.max(F.when(F.col("revenue_rank") == 1, F.col("total_revenue")))
    return locations.agg(
        F.count("*").alias("restaurants"),
        money(F.sum("total_revenue")).alias("total_revenue"),
        money_percent(top, F.sum("total_revenue")).alias("top_location_share_pct"),
        ratio(F.sum("retention_rate_pct"), F.count("retention_rate_pct"), 1).alias("avg_retention_pct"),
    )


def top_options(options: DataFrame, n: int = TOP_OPTIONS) -> DataFrame:
    """First ``n`` paid options by revenue with the text shown for them."""
    shown = F.concat(F.substring("option_group_name", 1, 30), F.lit(" / "), F.col("option_name"))
    return options.orderBy(F.desc("total_revenue"), "option_group_name", "option_name").limit(n).withColumn(
        "option_display", shown)
