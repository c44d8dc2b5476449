"""Time the headline reports; prints one JSON line.

The session is first warmed by a run of every report (code compiled, files
cached); then each report is run once more and timed ``BENCH_RUNS`` times (3),
with its whole result written to Spark's no-op sink, and the median counts.
Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gearyard.plans.reports import REPORTS
from gearyard.session import build_session

HEADLINE = [
    "items_enriched", "availability_latest", "availability_exists", "kpi_stock", "stock_breakdown",
    "price_histogram", "code_info", "sales_recent", "top_codes", "sales_recent_by_type", "needs_items",
    "needs_items_by_type", "needs_gearboxes", "sale_price_avg_3m", "price_evolution", "price_evolution_code",
    "price_movers_purchase", "price_movers_sale", "movers_up", "price_proposals", "smart_match",
    "plate_lookup", "needs_for_plate", "resolve_vendors", "append_targeted_offers", "recent_targeted_offers",
    "vendor_day_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REPORTS[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spark.catalog.clearCache()
        return seconds

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    for name in names:  # warm the whole session before anything is timed
        run(name)
    timings = {}
    for name in names:
        run(name)
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total warm wall time of the headline reports (median of runs)",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
