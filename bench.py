"""Times every registered query and prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names; all by default).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from mercantil.plans import registry


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(registry.QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # All rows and columns are computed, none is sent to the driver.
        registry.bound(name)(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("daily_sales")  # starts the JVM's compiler and the file caches
    times = {}
    for name in names:
        times[name] = round(run(name), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "sum of query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if "stream_orders" in times:
        events = spark.read.parquet(f"{folder}/events.parquet").count()
        result["stream_events_per_sec"] = round(events / times["stream_orders"], 1)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
