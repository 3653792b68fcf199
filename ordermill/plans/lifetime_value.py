"""Customer lifetime value per customer and day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.labels import spend_tier
from ordermill.functions.numbers import magnitude_bucket
from ordermill.operators.interval_statistics import Intervals, interval_tile_cuts, interval_values_at
from ordermill.operators.order_statistics import between, bucket_bits, rank_key, ranks_around, tile_start, with_tile
from ordermill.operators.timeline import expand_days, first_day_only, running_intervals
from ordermill.schemas import money, stamped
from ordermill.session import materialize

TIERS = 5
NO_SPEND = "Pre-Activity"
ROWS_PER_TASK = 16_000_000
# With three tiers a day, two pieces stay below the 128 groups from which an aggregate of sketches sorts its rows.
DAYS_PER_PIECE = 21


@dataclass(frozen=True)
class SpendIntervals:
    """Stored ``spend_intervals`` with sort key and bucket of the spend, and the number of tasks to expand them in.

    A few intervals expand to many days, so tasks and precision of the buckets follow from the rows of the expanded
    table: the days from each customer's first order to the end of the calendar, summed over the customer dimension.
    """

    rows: DataFrame
    bits: int
    tasks: int
    days: int

    @property
    def by_spend(self) -> Intervals:
        return Intervals(self.rows, "day", "until", "spend_key", "spend_bucket", "user_id")

    def expanded(self, only: Column | None = None, by_days: bool = False) -> DataFrame:
        """One row per customer and day (``date_key``), the only time that all days are written out.

        Dealt out by ranges of customers after the read: small files are packed together when they are read, and a
        task would expand all that is in its pack.  ``only`` names a single day to write out.  ``by_days`` deals out by
        ranges of days: intervals are cut into pieces of ``DAYS_PER_PIECE`` days, and a task has few days, for
        aggregates per day that keep a buffer for each.
        """
        rows = self.rows.drop("spend_bucket")
        if only is not None:
            held = rows.withColumn("_only", only).filter(F.col("_only").between(F.col("day"), F.col("until")))
            return held.withColumnRenamed("_only", "date_key")
        if by_days:
            span, first = F.lit(DAYS_PER_PIECE), F.unix_date("day")
            pieces = F.sequence(F.floor(first / span), F.floor(F.unix_date("until") / span))
            cut = rows.filter("until >= day").withColumn("_piece", F.explode(pieces)).withColumns({
                "_begin": F.greatest(F.col("day"), F.date_from_unix_date((F.col("_piece") * span).cast("int"))),
                "until": F.least(F.col("until"), F.date_from_unix_date(((F.col("_piece") + 1) * span - 1).cast("int")))})
            dealt = cut.repartitionByRange(max(self.tasks, self.days // DAYS_PER_PIECE), "_piece", "user_id")
            return expand_days(dealt, "_begin", "date_key").drop("_piece", "_begin")
        dealt = rows.repartitionByRange(self.tasks, "user_id", "day").sortWithinPartitions("user_id", "day")
        return expand_days(dealt, "day", "date_key")

    def spans(self, cuts: DataFrame) -> DataFrame:
        """The customer-days with their tier as (``date_key``, ``days``, ``clv_tier``, ``cumulative_spend``).

        A line stands for a customer on so many days from ``date_key`` on, all in one half of a month: on all of them if
        an interval covers the half and the tier is the same whether judged by the least or by the greatest boundaries
        of its days, else there is a line per day.
        """
        rows = self.rows.filter("until >= day").select("user_id", "day", "until", "spend_key", "cumulative_spend")
        rows = rows.repartitionByRange(self.tasks, "user_id", "day")
        half = F.explode(F.sequence(_half_month(F.col("day")), _half_month(F.col("until"))))
        first, last = _half_month_ends(F.col("_half"))
        halves = rows.withColumn("_half", half).withColumns({
            "_whole": (F.col("day") <= first) & (F.col("until") >= last),
            "_begin": F.greatest("day", first), "until": F.least("until", last)})
        # The tiers are told apart by the first boundary and the last.  A day without one lies below it as a whole.
        days_of_half = F.datediff(last, first) + 1
        ends = cuts.groupBy(_half_month(F.col("date_key")).alias("_half")).agg(*[
            end.alias(f"_{name}_{t}") for t in (2, TIERS) for name, end in (
                ("least", F.min(f"_cut_{t}")), ("greatest", F.when(F.count(f"_cut_{t}") == days_of_half, F.max(f"_cut_{t}"))))])
        same = [_reaches(f"_least_{t}") == _reaches(f"_greatest_{t}") for t in (2, TIERS)]
        halves = halves.join(ends, "_half", "left")
        whole = F.col("_whole") & same[0] & same[1]
        days = F.sequence("_begin", "until")
        lines = halves.withColumn("_whole", whole).select(
            "user_id", "spend_key", "cumulative_spend",
            F.when(F.col("_whole"), F.datediff("until", "_begin") + 1).otherwise(1).cast("bigint").alias("days"),
            F.explode(F.when(F.col("_whole"), F.slice(days, 1, 1)).otherwise(days)).alias("date_key"))
        tiered = with_tile(lines, "tile", TIERS, F.col("spend_key"), "user_id", ["date_key"], cuts)
        return tiered.select("date_key", "days", _clv_tier().alias("clv_tier"), "cumulative_spend")


def _half_month(day: Column) -> Column:
    """Number of the half month of a day: the first 15 days, or the days after."""
    return (F.year(day) * 12 + F.month(day) - 1) * 2 + (F.dayofmonth(day) > 15).cast("int")


def _half_month_ends(half: Column) -> tuple[Column, Column]:
    month = F.floor(half / 2).cast("int")
    first = F.make_date(F.floor(month / 12).cast("int"), month % 12 + 1, F.lit(1))
    later = half % 2 == 1
    return F.when(later, F.date_add(first, 15)).otherwise(first), F.when(later, F.last_day(first)).otherwise(F.date_add(first, 14))


def _reaches(cut: str) -> Column:
    key, boundary = F.col("spend_key"), F.col(cut)
    beyond = (key > boundary["key"]) | ((key == boundary["key"]) & (boundary["id"].isNull() | (F.col("user_id") >= boundary["id"])))
    return F.coalesce(beyond, F.lit(False))


def _clv_tier() -> Column:
    return F.when(F.col("cumulative_spend") > 0, spend_tier(F.col("tile"), TIERS)).otherwise(NO_SPEND)


def stored_intervals(fact: DataFrame, customers: DataFrame, calendar: DataFrame) -> SpendIntervals:
    spark = fact.sparkSession
    age = F.datediff(calendar.agg(F.max("date_key")).scalar(), F.col("first_order_date")) + 1
    rows, days = customers.agg(F.coalesce(F.sum(age), F.lit(0)), F.coalesce(F.max(age), F.lit(0))).first()
    bits = bucket_bits(rows, days)
    spend_key = rank_key(F.col("cumulative_spend"), 2)
    intervals = spend_intervals(fact, customers, calendar).withColumns({
        "spend_key": spend_key, "spend_bucket": magnitude_bucket(spend_key, bits)})
    return SpendIntervals(
        materialize(intervals, "spend-intervals"), bits, max(rows // ROWS_PER_TASK, spark.sparkContext.defaultParallelism), days)


def spend_intervals(fact: DataFrame, customers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per customer and day with an order (or the first day): running totals and how long they hold.

    The customer's first order day enters as a row without revenue, so that
    every customer has an interval from that day on, whatever the fact holds.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    orders = fact.filter(~F.col("is_anonymous")).select(
        "user_id", F.col("order_date").alias("day"), "total_revenue", F.lit(1).alias("orders"),
        F.lit(None).cast("date").alias("first_day"))
    starts = customers.select(
        "user_id", F.col("first_order_date").alias("day"), zero.alias("total_revenue"), F.lit(0).alias("orders"),
        F.col("first_order_date").alias("first_day"))
    daily = orders.unionByName(starts).filter(F.col("day").isNotNull()).groupBy("user_id", "day").agg(
        money(F.sum("total_revenue")).alias("daily_revenue"),
        F.sum("orders").alias("daily_order_count"),
        F.max("first_day").alias("first_day"),
    )
    # At most one row per calendar day and customer from here on.
    daily = daily.withColumn("first_order_date", F.max("first_day").over(Window.partitionBy("user_id")))
    daily = daily.filter(F.col("day") >= F.col("first_order_date")).drop("first_day")
    totals = {"cumulative_spend": "daily_revenue", "cumulative_orders": "daily_order_count"}
    intervals = running_intervals(daily, "user_id", "day", totals, calendar.agg(F.max("date_key")).scalar())
    return intervals.withColumn("cumulative_spend", money(F.col("cumulative_spend")))


def spend_cuts(intervals: SpendIntervals) -> DataFrame:
    """Stored boundaries between the fifths of each day."""
    return interval_tile_cuts(intervals.by_spend, TIERS, "date_key")


def clv_snapshot(
    fact: DataFrame, customers: DataFrame, calendar: DataFrame, run_ts: str | None = None,
    intervals: SpendIntervals | None = None, cuts: DataFrame | None = None, only: Column | None = None, by_days: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """One row per customer and day from the first order on, with running totals and the day's tier.

    Tiers are fifths of all customers of the day by running spend, equal spend
    ordered by id; customers who have spent nothing yet keep their place in the
    order but are labelled apart.  Boundaries come from the stored intervals;
    the dense rows are written out once, for the result, and never shuffled.
    The result is not stored: a condition on the customer is met before days
    are written out, and so is the one day ``only``.  ``cuts`` are
    ``spend_cuts`` if they are stored already; ``by_days`` as in ``expanded``; ``keyed`` adds ``spend_key``, the spend in cents.
    """
    intervals = intervals or stored_intervals(fact, customers, calendar)
    cuts = spend_cuts(intervals) if cuts is None else cuts
    tiered = with_tile(intervals.expanded(only, by_days), "tile", TIERS, F.col("spend_key"), "user_id", ["date_key"], cuts)
    result = tiered.withColumns({
        **first_day_only(["daily_revenue", "daily_order_count"], "day", "date_key"),
        "clv_tier": _clv_tier(),
        "days_since_first_order": F.datediff("date_key", "first_order_date"),
        "snapshot_year": F.year("date_key"),
    })
    result = result.withColumn("is_active_day", F.col("daily_revenue") > 0).select(
        "user_id", "date_key", money(F.col("daily_revenue")).alias("daily_revenue"), "daily_order_count",
        "cumulative_spend", "cumulative_orders", "clv_tier", "days_since_first_order", "is_active_day",
        "snapshot_year", *(["spend_key"] if keyed else []),
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


QUARTILES = {"p25_spend": 0.25, "median_spend": 0.5, "p75_spend": 0.75}


def clv_daily_stats(
    fact: DataFrame, customers: DataFrame, calendar: DataFrame, run_ts: str | None = None,
    intervals: SpendIntervals | None = None,
) -> DataFrame:
    """Customers and exact quartiles of running spend per day and tier, without the customer-days.

    In a day's order by spend each tier is a range of ranks, those who have spent nothing being first, so all
    quartiles are values at ranks of the day.  Days and tiers without customers have no row.
    """
    intervals = intervals or stored_intervals(fact, customers, calendar)
    second, last, n, unspent = tile_start(2, TIERS), tile_start(TIERS, TIERS), F.col("_n"), F.col("_unspent")
    no_spend = magnitude_bucket(F.lit(0).cast("bigint"), intervals.bits)
    tiers = {
        spend_tier_name: (F.greatest(begin, unspent), end)
        for spend_tier_name, begin, end in (("Low", F.lit(0), second), ("Medium", second, last), ("High", last, n))}
    ranks = {}
    for tier, (begin, end) in tiers.items():
        for name, p in QUARTILES.items():
            low, high = ranks_around(end - begin, p)
            ranks[f"{tier}_{name}_low"] = F.when(end > begin, begin + low)
            ranks[f"{tier}_{name}_high"] = F.when(end > begin, begin + high)
    values = interval_values_at(intervals.by_spend, "date_key", ranks, {"_unspent": F.col("_bucket") <= no_spend})
    lines = F.array(*[
        F.struct(
            F.lit(tier).alias("clv_tier"), (end - begin).cast("bigint").alias("customer_count"),
            *[between(F.col(f"{tier}_{name}_low"), F.col(f"{tier}_{name}_high"), end - begin, p, 2).alias(name)
              for name, p in QUARTILES.items()])
        for tier, (begin, end) in tiers.items()])
    result = values.select("date_key", F.inline(lines)).filter("customer_count > 0")
    return stamped(result, "gold_ingestion_ts", run_ts)
