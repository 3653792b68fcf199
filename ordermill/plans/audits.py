"""Audits of raw data: profiles, keys, dependencies and consistency."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numbers import money_percent, percent, ratio
from ordermill.operators.dedupe import surplus_rows
from ordermill.operators.distribution import count_and_share, range_label
from ordermill.operators.order_statistics import group_quantiles
from ordermill.plans.cleaning import ItemRules, item_stages
from ordermill.schemas import money

# The ranges of the published histograms and percentiles.
ITEMS_PER_ORDER = ((1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 5, "4-5"), (6, 10, "6-10"), (11, None, "11+"))
OPTIONS_PER_LINE = ((1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 4, "4"), (5, 5, "5"), (6, 7, "6-7"), (8, None, "8+"))
ORDERS_PER_CUSTOMER = (
    (1, 1, "1"), (2, 2, "2"), (3, 5, "3-5"), (6, 10, "6-10"), (11, 20, "11-20"), (21, 50, "21-50"),
    (51, 100, "51-100"), (101, None, "101+"),
)
QUANTITY_RANGES = (
    (0, 0, "0"), (1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 4, "4"), (5, 5, "5"), (6, 10, "6-10"),
    (11, 50, "11-50"), (51, None, "51+"),
)
# A sketch of 2**12 registers: one standard error is 0.8326 / 64 or 1.3 %, the stated bound four of them.
HLL_BITS = 12
DISTINCT_ERROR = 0.052
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def column_profile(df: DataFrame, exact: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULL or empty cells, percent filled and distinct values.

    Rows are never repeated per column.  All counts come from one aggregate over
    the wide rows.  Distinct values are exact for the columns named in ``exact``
    (all, if None): each is read by itself, which for a columnar table adds up
    to one read, and counted per value first, so a value that fills a column is
    one line from the first combine on.  For the other columns they come from an
    HLL sketch in the same aggregate, of fixed size (``DISTINCT_ERROR``).
    """
    columns = df.columns
    exact = columns if exact is None else list(exact)
    text = {c: F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns}
    sketched = {c: F.hll_sketch_estimate(F.hll_sketch_agg(text[c], HLL_BITS)) for c in columns if c not in exact}
    wide = df.agg(
        F.count("*").alias("_rows"), *[F.count(text[c]).alias(f"filled_{i}") for i, c in enumerate(columns)],
        *[sketched[c].alias(f"sketch_{i}") for i, c in enumerate(columns) if c in sketched])
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"filled_{i}").alias("filled"),
            (F.coalesce(f"sketch_{i}", F.lit(0)) if c in sketched else F.lit(None)).cast("bigint").alias("estimate"))
        for i, c in enumerate(columns)])
    profile = wide.select(F.inline(lines))
    distinct = F.col("estimate")
    if exact:
        counts = [
            df.select(text[c].alias("value")).groupBy("value").agg(F.count("*"))
            .agg(F.count("value").alias("exact_count")).select(F.lit(c).alias("column_name"), "exact_count")
            for c in exact]
        profile = profile.join(reduce(DataFrame.unionByName, counts), "column_name", "left")
        distinct = F.coalesce("exact_count", "estimate")
    return profile.filter("row_count > 0").select(
        "column_name", "row_count", (F.col("row_count") - F.col("filled")).alias("null_count"),
        percent(F.col("filled"), F.col("row_count"), 2).alias("filled_pct"), distinct.alias("distinct_count"))


def numeric_profile(df: DataFrame, column: str, upper: float, scale: int = 2) -> DataFrame:
    """One row: percentiles, zeros, negatives and values above ``upper``."""
    names = {f"p{p}": p / 100 for p in PERCENTILES}
    line = group_quantiles(df, [], F.col(column), names, scale, counted=True).select(F.struct(*names).alias("line")).scalar()
    value = F.col(column)
    return df.agg(
        F.count_if(value == 0).alias("zeros"),
        F.count_if(value < 0).alias("negatives"),
        F.count_if(value > upper).alias("outliers"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ).withColumns({name: line.getField(name) for name in names})


def value_distribution(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Values with counts and percent of all rows, the most frequent first; all or the first ``n``."""
    ordered = count_and_share(df, [column]).orderBy(F.desc("row_count"), F.col(column).asc_nulls_first())
    return ordered if n is None else ordered.limit(n)


def quantity_distribution(items: DataFrame) -> DataFrame:
    ranged = items.withColumn("quantity_range", range_label(F.col("ITEM_QUANTITY"), QUANTITY_RANGES))
    return count_and_share(ranged, ["quantity_range"])


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, keys and surplus rows of one table."""
    return surplus_rows(df, keys)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with the number of copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def dependency_audit(items: DataFrame, columns: Sequence[str], key: str = "ORDER_ID") -> DataFrame:
    """Per column: keys with more than one value of it.

    Smallest and greatest value differ exactly if there are several, which
    needs no distinct count.  NULLs do not count as a value.
    """
    spread = items.groupBy(key).agg(*[
        F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(c) for c in columns
    ])
    totals = spread.agg(F.count("*").alias("_keys"), *[F.count_if(c).alias(c) for c in columns])
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_keys").alias("key_count"), F.col(c).alias("violations"))
        for c in columns
    ])
    return totals.select(F.inline(lines))


def orphan_audit(items: DataFrame, options: DataFrame) -> DataFrame:
    """Option rows without a line item, and orders without and with options."""
    line = ["ORDER_ID", "LINEITEM_ID"]
    # Both tables are dealt out by order once; lines, and then orders, meet where they are.
    rows = items.select(*line, F.lit(True).alias("is_item")).unionByName(options.select(*line, F.lit(False).alias("is_item")))
    per_line = rows.repartition("ORDER_ID").groupBy(*line).agg(
        F.bool_or("is_item").alias("has_item"), F.count_if(~F.col("is_item")).alias("option_rows"))
    # A key with a NULL equals no line.
    met = F.col("has_item") & F.col("ORDER_ID").isNotNull() & F.col("LINEITEM_ID").isNotNull()
    sides = per_line.groupBy("ORDER_ID").agg(
        F.bool_or("has_item").alias("items"), F.bool_or(F.col("option_rows") > 0).alias("options"),
        F.sum(F.when(met, 0).otherwise(F.col("option_rows"))).alias("orphans"))
    both = F.col("items") & F.col("options")
    return sides.agg(
        F.count_if(both).alias("orders_in_both"),
        F.count_if(F.col("items") & ~F.col("options")).alias("orders_without_options"),
        F.count_if(~F.col("items")).alias("option_orders_without_items"),
        F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphan_option_rows"),
    )


def group_size_histogram(df: DataFrame, keys: Sequence[str], bounds) -> DataFrame:
    """How many groups have how many rows, by ranges of ``bounds``, with percent."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("size"))
    return count_and_share(sizes.withColumn("size_range", range_label(F.col("size"), bounds)), ["size_range"], "groups", 1)


def order_frequency(items: DataFrame) -> DataFrame:
    """Customers by number of orders, with percent and running percent."""
    per_customer = items.filter(F.col("USER_ID").isNotNull()).groupBy("USER_ID").agg(
        F.count_distinct("ORDER_ID").alias("orders"))
    labels = [label for _, _, label in ORDERS_PER_CUSTOMER]
    sizes = per_customer.withColumn("order_range", range_label(F.col("orders"), ORDERS_PER_CUSTOMER))
    counts = count_and_share(sizes, ["order_range"], "customers", 1)
    total = counts.agg(F.sum("customers")).scalar()
    # Eight lines at most.
    place = F.array_position(F.array(*map(F.lit, labels)), F.col("order_range"))
    running = F.sum("customers").over(Window.orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("cumulative_pct", percent(running, total)).orderBy(place)


def hour_distribution(items: DataFrame) -> DataFrame:
    """Raw rows per hour of the day, with percent."""
    hour = F.hour(F.try_to_timestamp(F.col("CREATION_TIME_UTC")))
    return count_and_share(items.withColumn("order_hour", hour), ["order_hour"], digits=1).orderBy("order_hour")


def yearly_volume(items: DataFrame) -> DataFrame:
    """Raw rows per year with percent and growth over the year before."""
    year = F.year(F.try_to_timestamp(F.col("CREATION_TIME_UTC")))
    counts = count_and_share(items.withColumn("order_year", year), ["order_year"], digits=1)
    before = F.lag("row_count").over(Window.orderBy("order_year"))
    growth = percent(F.col("row_count") - before, before)
    return counts.withColumn("growth_pct", growth).orderBy("order_year")


def yearly_revenue(items: DataFrame) -> DataFrame:
    """Cleaned item revenue, orders and mean order value per year."""
    return items.groupBy(F.year("order_date").alias("order_year")).agg(
        money(F.sum("line_item_revenue")).alias("revenue"),
        F.count_distinct("ORDER_ID").alias("orders"),
    ).withColumn("revenue_per_order", ratio(F.col("revenue"), F.col("orders")))


def cleaning_impact(raw_items: DataFrame, rules: ItemRules = ItemRules()) -> DataFrame:
    """Rows and revenue of raw items, of those the filters keep, and of those they remove."""
    kept = F.lit(True)
    for _, condition in item_stages(rules):
        kept = kept & F.coalesce(condition, F.lit(False))
    amount = (F.col("ITEM_PRICE").try_cast("decimal(10,2)") * F.col("ITEM_QUANTITY").try_cast("int"))
    zero = F.lit(0)
    return raw_items.select(kept.alias("kept"), amount.alias("amount")).agg(
        F.count("*").alias("raw_rows"),
        F.count_if("kept").alias("kept_rows"),
        money(F.coalesce(F.sum("amount"), zero)).alias("raw_revenue"),
        money(F.coalesce(F.sum(F.when(F.col("kept"), F.col("amount"))), zero)).alias("kept_revenue"),
    ).withColumns({
        "removed_rows": F.col("raw_rows") - F.col("kept_rows"),
        "removed_revenue": money(F.col("raw_revenue") - F.col("kept_revenue")),
        "removed_revenue_pct": money_percent(F.col("raw_revenue") - F.col("kept_revenue"), F.col("raw_revenue")),
    })


def card_consistency(items: DataFrame) -> DataFrame:
    """Rows by loyalty flag and presence of a card number."""
    return items.groupBy("IS_LOYALTY", F.col("PRINTED_CARD_NUMBER").isNotNull().alias("has_card")).agg(
        F.count("*").alias("row_count"))


def shared_cards(items: DataFrame) -> DataFrame:
    """Card numbers used by more than one customer."""
    pairs = items.select("PRINTED_CARD_NUMBER", "USER_ID").dropna().distinct()
    return pairs.groupBy("PRINTED_CARD_NUMBER").agg(F.count("*").alias("customers")).filter(F.col("customers") > 1)


def anonymous_with_card(items: DataFrame) -> DataFrame:
    """Anonymous rows by whether a card number could identify the customer."""
    return count_and_share(
        items.filter(F.col("USER_ID").isNull()).withColumn("has_card", F.col("PRINTED_CARD_NUMBER").isNotNull()),
        ["has_card"], digits=1)
