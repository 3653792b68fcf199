"""Table schemas, keys and names of the three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

ITEM_KEYS = ("ORDER_ID", "LINEITEM_ID")
OPTION_KEYS = ("ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME")
CALENDAR_KEYS = ("date_key",)

RAW_ITEMS = T.StructType([
    T.StructField("APP_NAME", T.StringType()),
    T.StructField("RESTAURANT_ID", T.StringType()),
    T.StructField("CREATION_TIME_UTC", T.StringType()),
    T.StructField("ORDER_ID", T.StringType()),
    T.StructField("USER_ID", T.StringType()),
    T.StructField("PRINTED_CARD_NUMBER", T.StringType()),
    T.StructField("IS_LOYALTY", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("LINEITEM_ID", T.StringType()),
    T.StructField("ITEM_CATEGORY", T.StringType()),
    T.StructField("ITEM_NAME", T.StringType()),
    T.StructField("ITEM_PRICE", T.DecimalType(18, 4)),
    T.StructField("ITEM_QUANTITY", T.IntegerType()),
])

RAW_OPTIONS = T.StructType([
    T.StructField("ORDER_ID", T.StringType()),
    T.StructField("LINEITEM_ID", T.StringType()),
    T.StructField("OPTION_GROUP_NAME", T.StringType()),
    T.StructField("OPTION_NAME", T.StringType()),
    T.StructField("OPTION_PRICE", T.DecimalType(18, 4)),
    T.StructField("OPTION_QUANTITY", T.IntegerType()),
])

# The calendar arrives as text in every column.
RAW_CALENDAR = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("date_key", "year", "month", "week", "day_of_week",
                 "is_weekend", "is_holiday", "holiday_name")
])

# The names under which serving tables are read.
SERVING_TABLES = (
    "dim_date",
    "dim_customer",
    "dim_restaurant",
    "dim_menu_item",
    "fact_orders",
    "gold_clv_snapshot",
    "gold_clv_daily_stats",
    "gold_rfm_segments",
    "gold_churn_indicators",
    "gold_sales_daily",
    "gold_sales_weekly",
    "gold_sales_monthly",
    "gold_loyalty_comparison",
    "gold_location_perf",
    "gold_upsell_summary",
    "gold_upsell_top_options",
)

PARTITION_COLUMNS = {
    "fact_orders": "order_year_month",
    "gold_clv_snapshot": "snapshot_year",
    "gold_sales_daily": "snapshot_year",
    "gold_sales_weekly": "order_year",
    "gold_sales_monthly": "order_year",
}

#: Tables that are asked for one value of a column: laid out by its ranges, with a filter of the values of each file.
LOOKUP_COLUMNS = {"gold_clv_snapshot": "user_id", "dim_customer": "user_id"}


def money(col: Column) -> Column:
    """Decimals grow with every sum and product; each table boundary brings them back."""
    return col.cast(MONEY)


def stamped(df: DataFrame, column: str, run_ts: str | None) -> DataFrame:
    """Add the load stamp of a run; without a run there is no stamp column."""
    return df if run_ts is None else df.withColumn(column, F.lit(run_ts))
