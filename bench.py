"""Headline queries on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully computed (`noop` sink) twice; the better time counts, so that JVM
start-up and code generation of the first query do not.
"""

from __future__ import annotations

import json
import os
import time

from shelfmark.session import build_session
from shelfmark.workload.queries import REGISTRY

HEADLINE = [
    "category_analytics", "brand_kpi_impact", "distributions", "daily_brand_revenue_all",
    "hourly_brand_trend_all", "brand_scorecard", "full_products", "product_documents_flat",
    "flatten_stream_batch", "normalize_pages_skus", "upsert_skus", "replace_children_skus",
    "check_key_skus", "price_indicators", "window_measures_3d", "held_for_10m", "metric_gauges",
    "evaluate_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="16g",
                          # Small files here: let AQE keep small partitions apart.
                          spark__sql__adaptive__coalescePartitions__minPartitionSize="128k")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
