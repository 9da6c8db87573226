"""Headline queries, timed: one JSON line on standard output.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "channel_dcomm",
    "channel_hsm",
    "channel_minis",
    "channel_haba",
    "raw_track",
    "best_match",
    "join_contains_ngram",
    "join_mapping_exact",
    "floor_union",
    "floor_single_pass",
    "floor_range",
    "override_rows",
    "gap_report",
    "derived_multiplier",
    "final_view",
    "merge_window",
    "clear_window",
    "track_roundtrip",
    "scan_file_window",
    "scan_schema_drift",
    "norm_folder",
    "last_date_by_account",
)


def main() -> None:
    import tempfile

    from pyspark.sql import SparkSession

    from checks.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in HEADLINES:
        taken = []
        for _ in range(repeats + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
