"""Times the headline queries on the tables of $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from millrace.plans import all_queries
from millrace.session import local_session

HEADLINE = [
    "device_health_hourly", "customer_metrics_daily", "device_daily_summary", "rolling_features",
    "threshold_events", "deduplicated", "runtime_summary", "sla_uptime", "expected_to_run",
    "as_of_previous_error", "latency_quantiles", "burn_rate", "alerts", "cache_replay",
    "screened_documents", "unique_documents", "window_chunks", "recursive_chunks", "vector_search",
    "keyword_search_all", "keyword_search_any", "hybrid_search", "stream_hourly_health",
    "stream_threshold_events",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    # One untimed run starts the Python workers and compiles the common code paths.
    registered["availability"].run(spark, root).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name].run(spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", root)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
