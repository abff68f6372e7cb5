"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names to time instead
"""

from __future__ import annotations

import json
import os
import time

from railloom.catalog import QUERIES
from railloom.session import local_session

HEADLINE = (
    "d36_directional_miles", "d37_service_miles", "d38_service_hours", "d39_stations", "d40_average_stops", "d41_line_summary",
    "d01_run_headers", "d02_folded_segments", "d04_filled_gaps", "d06_run_statistics", "c01_similar_runs", "d29_group_service",
    "d13_split_links", "d15_split_itineraries", "d17_deleted_nodes", "d20_scenario_network", "d22_period_itineraries",
    "d25_new_station", "d26_consolidated_station", "d28_all_actions", "g05_shortest_paths", "g07_route_vertices",
    "j17_node_zones", "k06_transit_lines", "k14_violations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    spark = local_session(cpus)
    # One small query first, so that start-up cost falls on none of the timed ones.
    QUERIES["d41_line_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1]}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
