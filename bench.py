"""Times the headline queries: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from milepost.session import spark_session  # noqa: E402
from testbed.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "trip_day_rollup", "trip_event_day_rollup", "performance_groups", "trip_event_groups",
    "driver_trip_list", "refresh_all_rollups", "conform_trip_score", "conform_driver_score",
    "conform_driver", "conform_trip_location", "conform_trip_incident", "dedup_trips_first",
    "dedup_locations", "dedup_incidents", "upsert_trips", "upsert_touch_points", "merge_counts",
    "flatten_grouped_payload", "explode_report_pages", "latest_run_per_fleet",
    "resolve_fleet_identity", "resolve_driver_user", "known_driver_trips", "driver_lookup",
    "enrich_report_rows", "trips_missing_details", "stamp_daily_scores", "fk_orphans",
    "rollup_key_violations", "conversion_summary", "coerce_int", "coerce_float", "text_or_null",
    "parse_metadata", "daily_windows", "top_scores", "incremental_load", "streaming_load",
    "daily_run", "trip_details_backfill", "incremental_rollups", "export_landed_columns",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first query pays for starting up; it is not counted
    QUERIES["trip_day_rollup"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
