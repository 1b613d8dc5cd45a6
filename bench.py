"""Times the headline queries on local cores and prints one JSON line.

The session is warmed up with every query once; then each is run three times, written to the no-op sink, and the median
counts. Queries on loads, pages and streams write their fixture inside the clock.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.plans.catalog import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "order_customer_date_price",
    "retail_derive",
    "cost_by_state_category",
    "cost_grouping_sets",
    "sales_per_product",
    "top10_products_by_region",
    "top5_products_by_region",
    "feb_march_by_year",
    "top_growth_subcategory",
    "review_report",
    "reviews_full_refresh",
    "symbol_stats",
    "daily_summary",
    "weather_report",
    "daily_summary_from_json",
    "single_occurrence_keys",
    "column_profile",
    "identity_keys",
    "value_counts_top10",
    "split_details",
    "number_unit_price",
    "load_continue",
    "load_skip_file",
    "rates_chain",
    "insert_only_merge",
    "scd1_merge",
    "scd1_merge_buckets",
    "snapshot_diff",
    "scd2_changes",
    "scd2_history",
    "html_grid",
    "html_cards",
    "page_menu_items",
    "stream_ingest_once",
    "stream_symbol_stats",
    "stream_quarantine",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
    for name in HEADLINE:
        seconds[name] = round(median(timed(spark, name, sf_dir) for _ in range(3)), 3)
    total = round(sum(seconds.values()), 3)
    sf = float(Path(sf_dir).name.removeprefix("sf")) if Path(sf_dir).name.startswith("sf") else None
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
