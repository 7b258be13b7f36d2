"""Windows without ticks, in batch and in a stream."""

import pytest
from pyspark.sql import functions as F

from ratewatch.operators import counts
from ratewatch.operators.silence import silent_windows, with_silent
from ratewatch.schemas import ANOMALY_TABLE
from ratewatch.streaming import jobs
from test_streams import Stream, alarms, record

BASE = 1_530_000_000_000


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def seconds(rows):
    return sorted((r["fx_marker"], r["s"], r["count"]) for r in rows.withColumn(
        "s", F.unix_seconds("window.start") - BASE // 1000
    ).collect())


def test_every_window_from_the_first_to_the_last_of_all_markers(make_ticks):
    found = counts.tumbling_count(make_ticks(("A", 0, 1.0, 1), ("A", 1, 1.0, 1), ("B", 30_000, 1.0, 1), (None, 5, 1.0, 1)))
    wanted = [("A", 0, 2), ("A", 10, 0), ("A", 20, 0), ("A", 30, 0), ("B", 0, 0), ("B", 10, 0), ("B", 20, 0), ("B", 30, 1)]
    assert seconds(with_silent(found, 10).where("fx_marker is not null")) == wanted


def test_a_given_range_and_given_markers(spark, make_ticks):
    found = counts.tumbling_count(make_ticks(("A", 0, 1.0, 1), ("B", 0, 1.0, 1)))
    expected = spark.createDataFrame([("B",), ("C",), ("C",), (None,)], "fx_marker string")
    at = [F.timestamp_millis(F.lit(BASE + ms)) for ms in (-10_000, 20_000)]
    assert seconds(silent_windows(found, 10, *at, expected)) == [
        ("B", -10, 0), ("B", 10, 0), ("C", -10, 0), ("C", 0, 0), ("C", 10, 0)
    ]
    assert silent_windows(found, 10, *reversed(at), expected).count() == 0


@pytest.mark.parametrize("duration", [7, 3600, 50_000, 86_400, 200_000])
def test_over_midnight_and_long_windows(spark, duration):
    times = spark.createDataFrame([(0,), (700_000,)], "s bigint").select(F.lit("A").alias("fx_marker"), F.timestamp_seconds("s").alias("ts"))
    full = with_silent(counts.tumbling_count(times, duration), duration)
    starts = sorted(r[0] for r in full.select(F.unix_seconds("window.start")).collect())
    assert starts == list(range(0, 700_000 // duration * duration + 1, duration))
    assert full.agg(F.sum("count")).first()[0] == 2


def test_no_counts_and_no_markers(make_ticks, spark):
    found = counts.tumbling_count(make_ticks(("A", 0, 1.0, 1)))
    assert with_silent(found.where("false"), 10).count() == 0
    assert silent_windows(found, 10, "2018-01-01", "2018-01-02", spark.createDataFrame([], "fx_marker string")).count() == 0


def test_the_spine_needs_no_nested_loop(make_ticks):
    found = counts.tumbling_count(make_ticks(("A", 0, 1.0, 1), ("B", 9, 1.0, 1)))
    text = with_silent(found, 10)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def two_markers(spark):
    schema = "fx_marker string, stream_stat_min double, stream_stat_max double"
    return spark.createDataFrame([("X", 1.0, 6.0), ("Y", 1.0, 6.0)], schema)


# Y stops after the first window; X goes on, leaves out [20, 30) and moves the watermark.
FILES = [[(0, "X"), (1, "X"), (2, "Y")], [(12, "X")], [(31, "X")], [(95, "X")], [(130, "X")], [(300, "X")]]


def test_a_source_that_stops_raises_alarms(spark, stream):
    limits = two_markers(spark)
    texts = ["\n".join(record(second, marker) for second, marker in file) for file in FILES]

    def start(topic, path, run):
        return jobs.run_anomalies(topic, limits, path, run, silent=True)

    stream.send(start, *texts, mode="append")
    rows = stream.table(ANOMALY_TABLE)
    # All windows up to [130, 140) are complete by the last message.
    own = {0.0, 10.0, 30.0, 90.0, 130.0}
    every = {float(s) for s in range(0, 140, 10)}
    assert alarms(rows.where("fx_marker = 'X'")) == [(s, 0.0) for s in sorted(every - own)]
    assert alarms(rows.where("fx_marker = 'Y'")) == [(s, 0.0) for s in sorted(every - {0.0})]


def test_silent_windows_need_append_mode(spark, stream):
    with pytest.raises(ValueError, match="append"):
        stream.send(lambda t, path, run: jobs.run_anomalies(t, two_markers(spark), path, run, silent=True), record(0))
