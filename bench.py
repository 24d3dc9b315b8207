"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to the end into the `noop` sink, three times; the best run counts. Preparatory
jobs of a query (written pairs, size checks, landing) are part of its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stationfield.plans.registry import QUERIES
from stationfield.session import build_session

# Light ones first: they warm the JVM up for the transforms.
HEADLINE = [
    "quality_score", "latest_version_obs", "latest_forecast_issue", "latest_obs", "db_status",
    "nearby_stations", "nearest_station_rank", "station_discovery", "postal_centroids",
    "conform_obs", "upsert_result", "hourly_window", "coverage", "forecast_horizon_refresh",
    "fc_by_postal_code", "obs_by_postal_code",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(2 * cpus),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
