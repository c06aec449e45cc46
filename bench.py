"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and is then timed over ``BENCH_RUNS`` runs (the
median counts). Rows are consumed by a sink that drops them, so nothing is
collected on the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from plantlens.plans.catalog import QUERIES

HEADLINE = [
    "resample_right_closed", "lake_canonical", "stale_runs", "canonical_dataset",
    "daily_build", "baseline_flags", "day_shape", "pi_trend14", "rule_labels",
    "inverter_divergence", "referee_verdicts", "event_rollup", "training_frame",
    "event_split", "yoy_rate", "datum_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        samples = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i or runs == 0:
                samples.append(time.perf_counter() - start)
        took[name] = round(statistics.median(samples), 3)
    print(json.dumps({
        "metric": "headline query seconds, total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
