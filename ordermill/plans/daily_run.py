"""The daily run over stored layers, and reloads of a date range.

Raw tables, clean tables, dimensions, the order fact and the metrics are built
in this order; a layer starts only if every table of the one before succeeded.
Tables of one layer do not depend on each other and are built side by side in
one session.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.plans.churn import churn_indicators
from ordermill.plans.cleaning import ItemRules, clean_calendar, clean_options, clean_order_items
from ordermill.plans.dependents import REFRESHED, refresh
from ordermill.plans.dimensions import dim_customer, dim_date, dim_menu_item, dim_restaurant
from ordermill.plans.lifetime_value import clv_daily_stats, clv_snapshot, stored_intervals
from ordermill.plans.locations import location_perf
from ordermill.plans.loyalty import loyalty_comparison
from ordermill.plans.orders import fact_orders
from ordermill.plans.sales import sales_daily, sales_monthly, sales_weekly
from ordermill.plans.segments import rfm_segments
from ordermill.plans.upsell import upsell_summary, upsell_top_options
from ordermill.schemas import CALENDAR_KEYS, ITEM_KEYS, OPTION_KEYS, LOOKUP_COLUMNS, PARTITION_COLUMNS, SERVING_TABLES
from ordermill.session import brief_shuffles, materialize, scratch_scope
from ordermill.sources.holidays import us_holidays
from ordermill.sources.lake import CLEAN, RAW, SERVING, Lake, TableSpec
from ordermill.sources.run_log import append_run, volume_status

log = logging.getLogger(__name__)

ITEMS, OPTIONS, CALENDAR = "order_items", "order_item_options", "date_dim"
LOAD_DATE, CLEANED = "ingestion_date", "cleaned"
MONTH = PARTITION_COLUMNS["fact_orders"]

SOURCES = (
    TableSpec(ITEMS, ITEM_KEYS),
    TableSpec(OPTIONS, OPTION_KEYS),
    TableSpec(CALENDAR, CALENDAR_KEYS, strategy="overwrite"),
)

Reader = Callable[[TableSpec], DataFrame]
Step = Callable[[], None]


@dataclass(frozen=True)
class Run:
    """What all steps of one run share."""

    lake: Lake
    read: Reader
    run_date: str
    run_ts: str
    rules: ItemRules = ItemRules()
    sources: Sequence[TableSpec] = SOURCES
    side_by_side: int = 4
    #: Clean all of the raw layer again, after a change of rules.
    clean_all: bool = False
    stage_counts: dict[str, Mapping[str, int]] = field(default_factory=dict)


class Once:
    """What several steps of a layer need, made by the first that asks; one that fails is made again for the next."""

    def __init__(self, make: Callable) -> None:
        self.make, self.lock, self.made = make, Lock(), None

    def __call__(self):
        with self.lock:
            if self.made is None:
                with scratch_scope(keep=True):
                    self.made = self.make()
            return self.made


def _attempt(steps: Mapping[str, Step], side_by_side: int) -> dict[str, str]:
    """Run the steps of a layer; one that fails does not stop the others."""

    def run(name: str) -> str:
        try:
            steps[name]()
            return "SUCCESS"
        except Exception as error:  # the status line carries the failure
            log.exception("table %s failed", name)
            return f"FAILED: {error}"

    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        return dict(zip(steps, pool.map(run, steps)))


def ingest_raw(run: Run) -> dict[str, str]:
    """Copy the sources into the raw layer, stamped with the load date and time."""

    def step(spec: TableSpec) -> Step:
        def load() -> None:
            stamped = run.read(spec).withColumns({
                LOAD_DATE: F.lit(run.run_date), "ingestion_timestamp": F.lit(run.run_ts)})
            if spec.strategy == "overwrite":
                run.lake.overwrite(stamped, RAW, spec.name, [LOAD_DATE])
            else:
                run.lake.upsert(stamped, RAW, spec.name, spec.keys, [LOAD_DATE], rebalance=False)
        return load

    return _attempt({spec.name: step(spec) for spec in run.sources}, run.side_by_side)


def upsert_clean_items(lake: Lake, items: DataFrame, marks: Mapping[str, str] | None = None) -> int:
    """Merge cleaned line items into the clean layer, which is laid out by order month: other months stay as they are."""
    by_month = items.withColumn(MONTH, F.date_format("order_date", "yyyy-MM"))
    return lake.upsert(by_month, CLEAN, ITEMS, ITEM_KEYS, [MONTH], marks)


def clean_layer(run: Run) -> dict[str, str]:
    """Clean the load dates that no run has cleaned yet; row counts per filter come from the writing job itself.

    How far cleaning has come is a mark in the clean snapshot, published with it.  The run's own date is read even if
    an earlier attempt has cleaned it.  Where cleaning makes several raw keys one, the later load wins.
    A clean row stays if a later load has it in a form that cleaning drops, as an upsert only adds and replaces.
    """
    lake = run.lake

    def unseen(table: str) -> DataFrame:
        raw, done = lake.read(RAW, table), lake.marks(CLEAN, table).get(CLEANED)
        if run.clean_all or done is None:
            return raw
        return raw.filter((F.col(LOAD_DATE) > F.lit(done)) | (F.col(LOAD_DATE) == F.lit(run.run_date)))

    def observed(
        table: str, raw: Callable[[], DataFrame], clean: Callable[[DataFrame, Observation], DataFrame],
        write: Callable[[DataFrame, dict[str, str]], int],
    ) -> Step:
        def step() -> None:
            rows = raw()
            if lake.exists(CLEAN, table) and rows.isEmpty():  # nothing new: partitions without files
                return
            observation = Observation(table)
            done = max(lake.marks(CLEAN, table).get(CLEANED, ""), run.run_date)
            write(clean(rows, observation), {CLEANED: done})
            run.stage_counts[table] = observation.get
        return step

    steps = {
        ITEMS: observed(
            ITEMS, lambda: unseen(ITEMS), lambda raw, o: clean_order_items(raw, run.rules, run.run_ts, o),
            lambda df, marks: upsert_clean_items(lake, df, marks)),
        OPTIONS: observed(
            OPTIONS, lambda: unseen(OPTIONS), lambda raw, o: clean_options(raw, run.run_ts, o),
            lambda df, marks: lake.upsert(df, CLEAN, OPTIONS, OPTION_KEYS, [LOAD_DATE], marks)),
        CALENDAR: observed(
            CALENDAR, lambda: lake.read(RAW, CALENDAR), lambda raw, o: clean_calendar(raw, run.run_ts, o),
            lambda df, marks: lake.overwrite(df, CLEAN, CALENDAR, [LOAD_DATE], marks=marks)),
    }
    return _attempt(steps, run.side_by_side)


def _serve(run: Run, tables: Mapping[str, Callable[[], DataFrame]]) -> dict[str, str]:
    def step(name: str) -> Step:
        parts = [PARTITION_COLUMNS[name]] if name in PARTITION_COLUMNS else []

        def write() -> None:
            with scratch_scope():
                # Months are many, years are few: only the fact is brought together by partition.
                run.lake.overwrite(
                    tables[name](), SERVING, name, parts, rebalance=name == "fact_orders", lookup=LOOKUP_COLUMNS.get(name))
        return write

    return _attempt({name: step(name) for name in tables}, run.side_by_side)


def dimension_layer(run: Run) -> dict[str, str]:
    def items() -> DataFrame:
        return run.lake.read(CLEAN, ITEMS)

    ts = run.run_ts
    return _serve(run, {
        "dim_date": lambda: dim_date(items(), us_holidays(run.lake.spark), ts),
        # The customer-days come in ranges of customers as they are expanded.
        "dim_customer": lambda: dim_customer(items(), ts).repartitionByRange("user_id").sortWithinPartitions("user_id"),
        "dim_restaurant": lambda: dim_restaurant(items(), ts),
        "dim_menu_item": lambda: dim_menu_item(items(), ts),
    })


def fact_layer(run: Run) -> dict[str, str]:
    lake = run.lake
    return _serve(run, {
        "fact_orders": lambda: fact_orders(lake.read(CLEAN, ITEMS), lake.read(CLEAN, OPTIONS), run.run_ts)})


def metric_layer(run: Run) -> dict[str, str]:
    lake, ts = run.lake, run.run_ts

    def fact() -> DataFrame:
        return lake.load("fact_orders")

    def customers() -> DataFrame:
        return lake.load("dim_customer")

    def options() -> DataFrame:
        return lake.read(CLEAN, OPTIONS)

    spending = Once(lambda: stored_intervals(fact(), customers(), lake.load("dim_date")))
    return _serve(run, {
        "gold_clv_snapshot": lambda: clv_snapshot(fact(), customers(), lake.load("dim_date"), ts, spending()),
        "gold_clv_daily_stats": lambda: clv_daily_stats(fact(), customers(), lake.load("dim_date"), ts, spending()),
        "gold_rfm_segments": lambda: rfm_segments(fact(), customers(), run_ts=ts),
        "gold_churn_indicators": lambda: churn_indicators(fact(), ts),
        "gold_sales_daily": lambda: sales_daily(lake.read(CLEAN, ITEMS), ts),
        "gold_sales_weekly": lambda: sales_weekly(fact(), ts),
        "gold_sales_monthly": lambda: sales_monthly(fact(), ts),
        "gold_loyalty_comparison": lambda: loyalty_comparison(fact(), ts),
        "gold_location_perf": lambda: location_perf(fact(), ts),
        "gold_upsell_summary": lambda: upsell_summary(options(), fact(), ts),
        "gold_upsell_top_options": lambda: upsell_top_options(options(), ts),
    })


LAYERS: tuple[tuple[str, Callable[[Run], dict[str, str]], str], ...] = (
    ("ingest", ingest_raw, RAW),
    ("clean", clean_layer, CLEAN),
    ("dimensions", dimension_layer, SERVING),
    ("fact", fact_layer, SERVING),
    ("metrics", metric_layer, SERVING),
)


def _gates(run: Run, layer: str, counts: Mapping[str, int], log_path: str, least_pct: float = 95.0) -> dict[str, str]:
    """Soft gates of a layer, by table: rows that cleaning kept, fact rows against the run before.  They stop nothing."""
    found: dict[str, str] = {}
    if layer == "clean":
        for table, seen in run.stage_counts.items():
            if table in counts and seen["rows_in"]:
                kept = 100 * min(seen.values()) / seen["rows_in"]
                found[table] = "OK" if least_pct <= kept <= 100 else "FLAGGED"
    if layer == "fact" and "fact_orders" in counts:
        found["fact_orders"] = volume_status(run.lake.spark, log_path, "fact_orders", counts["fact_orders"])
    for table, status in found.items():
        if status != "OK":
            log.warning("%s of layer %s: %s, %s rows", table, layer, status, counts[table])
    return found


def run_daily(run: Run, strict: bool = False) -> dict[str, dict[str, str]]:
    """All layers in order, each logged with its status and row counts.

    Returns the table statuses per layer; layers after a failure are missing,
    or, if ``strict``, a failure is raised once it is logged.
    """
    if run.lake.spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError("order days and hours are those of UTC: set spark.sql.session.timeZone to UTC")
    done: dict[str, dict[str, str]] = {}
    for name, build, layer in LAYERS:
        statuses = build(run)
        done[name] = statuses
        counts = {
            table: run.lake.read(layer, table).count() for table, status in statuses.items() if status == "SUCCESS"
        }
        log_path = f"{run.lake.root}/run_log"
        status = append_run(
            run.lake.spark, log_path, name, run.run_date, run.run_ts, statuses, counts, _gates(run, name, counts, log_path))
        if status != "SUCCESS":
            log.error("layer %s ended with %s, later layers are skipped", name, status)
            if strict:
                raise RuntimeError(f"layer {name} ended with {status}: {statuses}")
            break
    return done


def reload_range(run: Run, start: date, end: date, dependents: bool = False) -> list[str]:
    """Read the line items of a date range again, with their options, and bring the fact up to date.

    Raw and clean tables are upserted.  Of the fact the months of the range are
    rewritten, and those that the orders read again stood in before, so an
    order that moves to another day leaves no row behind.  With ``dependents``
    sales, locations and loyalty follow at once, by counting the touched groups
    again; the other tables follow from the next daily run, ``stale_after_reload``
    names them.  Returns the months rewritten.
    """
    lake = run.lake
    fact_before = lake.load("fact_orders")
    specs = {spec.name: spec for spec in run.sources}
    day = F.to_date(F.try_to_timestamp(F.col("CREATION_TIME_UTC")))
    items = run.read(specs[ITEMS]).filter(day.between(F.lit(start), F.lit(end)))
    items = materialize(items, "reload-items")
    orders = items.select("ORDER_ID").distinct()
    options = run.read(specs[OPTIONS]).join(orders, "ORDER_ID", "left_semi")
    stamps = {LOAD_DATE: F.lit(run.run_date), "ingestion_timestamp": F.lit(run.run_ts)}
    for name, keys, extract, clean in (
        (ITEMS, ITEM_KEYS, items, lambda df: upsert_clean_items(lake, clean_order_items(df, run.rules, run.run_ts))),
        (OPTIONS, OPTION_KEYS, options, lambda df: lake.upsert(
            clean_options(df, run.run_ts), CLEAN, OPTIONS, OPTION_KEYS, [LOAD_DATE], rebalance=False)),
    ):
        extract = extract.withColumns(stamps)
        lake.upsert(extract, RAW, name, keys, [LOAD_DATE], rebalance=False)
        clean(extract)
    with brief_shuffles(lake.spark):
        stood = fact_before.join(orders.select(F.col("ORDER_ID").alias("order_id")), "order_id", "left_semi").select(MONTH).distinct()
        stood = [row[0] for row in stood.collect()]  # one line per month
    asked = {f"{y:04d}-{m:02d}" for y in range(start.year, end.year + 1) for m in range(1, 13)
             if (start.year, start.month) <= (y, m) <= (end.year, end.month)}
    months = sorted(asked | {month for month in stood if month})
    affected = lake.read(CLEAN, ITEMS).filter(F.col(MONTH).isin(months))
    theirs = lake.read(CLEAN, OPTIONS).join(affected.select("ORDER_ID").distinct(), "ORDER_ID", "left_semi")
    fact = fact_orders(affected, theirs, run.run_ts)
    lake.replace_partitions(fact, SERVING, "fact_orders", MONTH, months)
    if dependents:
        refresh(lake, lake.read(CLEAN, ITEMS), fact_before, months, run.run_ts)
    return months


def stale_after_reload(run: Run, dependents: bool = False) -> list[str]:
    """Serving tables that a range reload leaves as they were, to be built again by the next daily run."""
    done = ("fact_orders", *(REFRESHED if dependents else ()))
    return [name for name in SERVING_TABLES if name not in done and run.lake.exists(SERVING, name)]
