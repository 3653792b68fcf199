"""Time the jobs of the daily run and the heaviest reports on the sample tables.

Each job reads the stored tables of the layers before it and stores its result,
as in a daily run.  Prints one JSON line; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.registry import QUERIES, Tables, plain
from ordermill.session import build_session, use_checkpoint_folder

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# In the order of a daily run; a table built for one query is stored for those after it.
HEADLINES = (
    "item_stage_counts", "clean_order_items", "clean_options", "dim_date", "dim_customer", "dim_restaurant",
    "dim_menu_item", "fact_orders", "clv_days", "rfm_segments", "churn_indicators", "sales_daily", "sales_weekly",
    "sales_monthly", "loyalty_comparison", "location_perf", "upsell_summary", "upsell_top_options",
    "clv_daily_stats", "rep_clv_by_day", "rep_clv_kpis", "rep_trajectory", "rep_segment_leaderboard", "rep_churn_breakdown",
    "aud_profile_items", "aud_dependency", "upsert_items",
)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "20g"})
    use_checkpoint_folder(spark).sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, FOLDER)
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        started = time.perf_counter()
        plain(QUERIES[name](tables)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "daily jobs and reports, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
