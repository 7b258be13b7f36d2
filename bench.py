"""Run every registered query once and print the seconds as one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from ratewatch.plans.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratewatch-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ticks_of_events"](spark, sf_dir).count()
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        begin = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
