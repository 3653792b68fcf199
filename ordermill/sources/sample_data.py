"""The star-schema sample tables seen as raw order data.

Line items, orders and parts become raw line items and options with test
orders, damaged categories, outliers, anonymous customers and repeated keys.
Dates are moved by 25 years, into the range of the holiday list.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS_LATER = 9131
TEST_APP, TEST_RESTAURANT = "Shop - DEVELOPMENT", "R27"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _line_id():
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _order_time():
    hours = F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return (F.col("o_orderdate") + F.make_interval(days=F.lit(DAYS_LATER)) + hours).cast("timestamp")


def whole_number(amount: Column) -> Column:
    """``round(amount)`` of a double as a bigint, halves away from zero, without the decimal that ``round`` goes through."""
    whole = amount.cast("bigint")
    rest = amount - whole
    return whole + F.when((rest >= 0.5) & (rest < 1), 1).when((rest <= -0.5) & (rest > -1), -1).otherwise(0)


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders, parts = (_read(spark, folder, t) for t in ("lineitem", "orders", "part"))
    # The text of the time is made once an order, not once a line.
    second = F.date_format(_order_time(), "yyyy-MM-dd'T'HH:mm:ss")
    orders = orders.withColumn("o_time", F.concat(second, F.when(F.col("o_orderkey") % 100 == 0, "Z").otherwise(".000Z")))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey"))
    part, supplier, order = F.col("l_partkey"), F.col("l_suppkey") % 40, F.col("o_orderkey")
    loyal = F.col("o_orderpriority") == "1-URGENT"
    customer = F.col("o_custkey").cast("string")
    # Filters on the price work it out again for each limit, so it has to be cheap.
    cents = whole_number(F.col("l_extendedprice") * 100) % 5200
    return joined.select(
        F.when(part % 97 == 0, TEST_APP).when(part % 50 == 1, "Shop Perks").otherwise("Shop").alias("APP_NAME"),
        F.concat(F.lit("R"), (order % 28).cast("string")).alias("RESTAURANT_ID"),
        F.col("o_time").alias("CREATION_TIME_UTC"),
        F.col("l_orderkey").cast("string").alias("ORDER_ID"),
        F.when(order % 11 != 0, customer).alias("USER_ID"),
        F.when(loyal, F.concat(F.lit("C"), customer)).alias("PRINTED_CARD_NUMBER"),
        F.when(loyal, "TRUE").otherwise("FALSE").alias("IS_LOYALTY"),
        F.lit("USD").alias("CURRENCY"),
        _line_id().alias("LINEITEM_ID"),
        F.when(supplier == 0, F.concat("p_type", F.lit("https://x.example/")))
        .when(supplier == 1, "")
        .when(supplier == 2, F.concat(F.lit(" "), "p_type", F.lit(" ")))
        .when(part % 499 == 0, "Test Items")
        .otherwise(F.col("p_type")).alias("ITEM_CATEGORY"),
        F.col("p_name").alias("ITEM_NAME"),
        (cents.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("ITEM_PRICE"),
        (F.col("l_quantity").cast("int") % 23).alias("ITEM_QUANTITY"),
    )


def raw_order_item_options(spark: SparkSession, folder: str) -> DataFrame:
    lines = _read(spark, folder, "lineitem").filter(F.col("l_discount") > 0)
    flag = F.col("l_returnflag")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("ORDER_ID"),
        _line_id().alias("LINEITEM_ID"),
        F.when(flag == "A", "CT Milk Options").when(flag == "N", "MILK OPTIONS").otherwise("Syrup")
        .alias("OPTION_GROUP_NAME"),
        F.concat(F.lit(" add "), "l_linestatus", (F.col("l_suppkey") % 5).cast("string"), F.lit(" "))
        .alias("OPTION_NAME"),
        F.round(F.col("l_tax") * 100).cast("decimal(10,2)").alias("OPTION_PRICE"),
        F.lit(1).alias("OPTION_QUANTITY"),
    )


def raw_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar text for every day that has an order; every 50th day carries an impossible date."""
    day = _order_time().cast("date")
    days = _read(spark, folder, "orders").select(day.alias("d")).distinct()
    d = F.col("d")
    number = F.unix_date(d)
    weekend = F.dayofweek(d).isin(1, 7)
    return days.select(
        F.concat(F.when(number % 50 == 0, "32-").otherwise(F.date_format(d, "dd-")), F.date_format(d, "MM-yyyy"))
        .alias("date_key"),
        F.year(d).cast("string").alias("year"),
        F.month(d).cast("string").alias("month"),
        F.weekofyear(d).cast("string").alias("week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.when(weekend, "TRUE").otherwise("false").alias("is_weekend"),
        F.when(number % 30 == 0, " yes ").when(number % 30 == 1, "maybe").otherwise("0").alias("is_holiday"),
        F.when(number % 30 == 0, " Labor Day ").when(number % 30 == 1, "  ").alias("holiday_name"),
    )


def raw_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as orders of one line item; unlike the orders above they have real times of day."""
    events = _read(spark, folder, "events").filter(F.col("event_type") == "purchase")
    user = F.col("user_id")
    key = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    cents = F.round(F.col("value") * 100).cast("bigint") % 5200
    return events.select(
        F.lit("Shop").alias("APP_NAME"),
        F.concat(F.lit("R"), (user % 5).cast("string")).alias("RESTAURANT_ID"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("CREATION_TIME_UTC"),
        key.alias("ORDER_ID"),
        user.cast("string").alias("USER_ID"),
        F.lit(None).cast("string").alias("PRINTED_CARD_NUMBER"),
        F.when(user % 4 == 0, "TRUE").otherwise("FALSE").alias("IS_LOYALTY"),
        F.lit("USD").alias("CURRENCY"),
        key.alias("LINEITEM_ID"),
        F.col("event_type").alias("ITEM_CATEGORY"),
        F.col("event_type").alias("ITEM_NAME"),
        (cents.cast("decimal(10,0)") / 100).cast("decimal(10,2)").alias("ITEM_PRICE"),
        F.lit(1).alias("ITEM_QUANTITY"),
    )


def damaged_order_items(items: DataFrame) -> DataFrame:
    """Raw line items with every kind of damage that cleaning repairs or drops.

    Category names damaged in each known way, missing keys, apps and locations, times and flags that cannot be read,
    and cards that several customers share, all by a number of the line.
    """
    order, line = (F.split_part("LINEITEM_ID", F.lit("-"), F.lit(part)).cast("bigint") for part in (1, 2))
    numbered = items.withColumn("n", order * 7 + line)

    def every(k: int, rest: int = 0):
        return F.col("n") % k == rest

    category = F
    for rest, name in enumerate((
        "Grill BBQ Plates 2", "Bowls0", "  Sandwiches, hot", "Drip C0offee", "Sqalads", "Kids", "Kid's Menu", None, "   ",
    )):
        category = category.when(every(23, rest), F.lit(name))
    loyal = F.when(every(13, 0), "true").when(every(13, 1), "False").when(every(13, 2), "maybe").when(every(13, 3), F.lit(None))
    time = F.when(every(43), "not a time").when(every(47), F.lit(None)).when(every(53), "")
    shared = every(17) & F.col("PRINTED_CARD_NUMBER").isNotNull()
    return numbered.withColumns({
        "ITEM_CATEGORY": category.otherwise(F.col("ITEM_CATEGORY")),
        "APP_NAME": F.when(~every(29), F.col("APP_NAME")),
        "RESTAURANT_ID": F.when(~every(31), F.col("RESTAURANT_ID")),
        "CREATION_TIME_UTC": time.otherwise(F.col("CREATION_TIME_UTC")),
        "IS_LOYALTY": loyal.otherwise(F.col("IS_LOYALTY")),
        "PRINTED_CARD_NUMBER": F.when(shared, F.concat(F.lit("S"), (F.col("n") % 5).cast("string"))).otherwise(
            F.col("PRINTED_CARD_NUMBER")),
        "ORDER_ID": F.when(~every(37), F.col("ORDER_ID")),
        "LINEITEM_ID": F.when(~every(41), F.col("LINEITEM_ID")),
    }).drop("n")
