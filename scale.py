"""Time window, version and parse operators on generated ticks of which one marker has a third.

    python scale.py [millions of ticks] [hours they cover]

Prints one JSON line with the seconds of each. The ticks exist for this run only.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.operators import counts, framing, latest, ticks, trends
from ratewatch.schemas import TICK_KEY, WIRE_FIELDS

START = 1_700_000_000_000
MARKERS = 500


def generated(spark: SparkSession, rows: int, hours: float, path: str) -> DataFrame:
    """Ticks spread evenly over the time, a third of them of one marker."""
    marker = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("M"), F.col("id") % MARKERS))
    ms = (F.lit(START) + F.floor(F.col("id") * F.lit(hours * 3_600_000 / rows))).cast("bigint")
    made = spark.range(rows).select(
        F.col("id").alias("event_id"),
        marker.alias("fx_marker"),
        ms.alias("timestamp_ms"),
        (F.col("id") % 97).cast("double").alias("bid_big"),
        (F.col("id") % 89).cast("int").alias("bid_points"),
    )
    made = made.withColumn("ts", F.timestamp_millis("timestamp_ms"))
    made.withColumn("timestamp_d", F.to_date("ts")).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    rows = int(float(sys.argv[1]) * 1_000_000) if len(sys.argv) > 1 else 20_000_000
    hours = float(sys.argv[2]) if len(sys.argv) > 2 else 24.0
    folder = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="run-")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    table = generated(spark, rows, hours, f"{folder}/scale-ticks")
    texts = [F.lit("1").alias(name) if name not in table.columns else F.col(name) for name in WIRE_FIELDS]
    records = framing.record_json(table.select("event_id", *texts))
    jobs = {
        "sliding_mean": trends.sliding_mean(table),
        "sliding_mean_without_sums": trends.sliding_mean(table, sum_first=False),
        "tumbling_count": counts.tumbling_count(table),
        "latest": latest.latest(table, TICK_KEY, "event_id"),
        "newest_100_per_marker": latest.recent_per(table, 100, "fx_marker", "ts", "event_id"),
        "newest_2000_per_marker": latest.recent_per(table, 2000, "fx_marker", "ts", "event_id"),
        "parse_records": ticks.typed(ticks.decode(records)),
    }
    jobs["tumbling_count"].count()
    seconds = {}
    for name, job in jobs.items():
        begin = time.perf_counter()
        job.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 2)
    spark.stop()
    print(json.dumps({"ticks": rows, "hours": hours, "seconds": seconds}))


if __name__ == "__main__":
    main()
