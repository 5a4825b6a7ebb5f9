"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Each query runs to completion into the no-op
sink. One untimed query first starts the workers. Give names as arguments to time other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tracewarden.catalog.all_queries import QUERIES
from tracewarden.session import local_session

HEADLINE = [
    "log_parse", "ip_frequency", "top_ips", "log_summary", "brute_force", "port_scan", "ddos_burst",
    "sql_injection", "detect_all", "static_analysis", "path_prefix_counts", "out_degree", "high_degree_nodes",
    "components_weak", "packet_features", "rate_limit", "packet_alerts", "rule_classifier",
    "serverlog_features", "flow_volume_features", "byte_histogram", "flow_features", "alert_origin",
    "byte_entropy_histogram", "bfs", "classifier_fit", "stream_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("status_distribution")
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
