"""Time the headline queries: one warm-up and one measured run each, results fully computed.

Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import time

from storelens import catalog
from storelens.session import local_session

HEADLINE = [
    "kpi_table", "kpi_records", "lookup_alerts_warning",
    "geo_enriched_stores", "geo_clusters", "geo_competition_density", "geo_stores_near_point",
    "fx_usd_amounts", "fx_dated_amounts",
    "clean_exact_copies", "clean_key_copies", "clean_interpolate", "clean_iqr_outliers", "clean_fill_dates",
    "clean_report",
    "region_monthly", "region_weekly", "same_store_yoy", "market_penetration", "concentration_index",
    "currency_exposure", "region_full_summary",
    "report_headline", "report_store_map", "report_daily_revenue", "report_store_ranking",
    "contract_typed_rows", "contract_violations", "state_dead_letter_statistics", "transform_cleaned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus, "16g")
    queries, seconds = catalog.queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, warm, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))


if __name__ == "__main__":
    main()
