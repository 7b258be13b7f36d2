"""Results corrected by ticks that came too late for the stream."""

import pytest
from pyspark.sql import functions as F

from ratewatch.schemas import COUNT_TABLE, MEAN_TABLE
from ratewatch.sources import tables
from ratewatch.streaming import corrections, jobs
from test_streams import BASE, Stream, record


class Late(Stream):
    """A stream whose ticks are stored, too."""

    def feed(self, start, *values, **settings):
        def both(topic, path, run):
            kept = type(run)(f"{self.folder}/stored", "append", once=True)
            jobs.run_store_ticks(topic, f"{self.folder}/ticks", f"{self.folder}/bad", kept).awaitTermination()
            return start(topic, path, run)

        self.send(both, *values, **settings)

    def fix(self, recompute, schema, duration=10):
        paths = (f"{self.folder}/{name}" for name in ("ticks", "table", "fixed"))
        return corrections.correct(self.spark, *paths, recompute, schema, duration)

    def fixed(self, schema, value):
        rows = corrections.read_corrected(self.spark, f"{self.folder}/table", f"{self.folder}/fixed", schema)
        second = (F.unix_millis("window_start") - BASE) / 1000
        return {(r["fx_marker"], r["s"]): r[value] for r in rows.withColumn("s", second).collect()}


@pytest.fixture
def stream(spark, tmp_path):
    return Late(spark, tmp_path)


def counted(topic, path, run):
    return jobs.run_counts(topic, path, run)


def test_late_ticks_and_late_windows(stream):
    stream.feed(counted, record(0), record(200), record(210), "\n".join([record(5), record(50, "Y"), record(215)]), mode="append")
    assert stream.late == 2
    changed = stream.fix(corrections.counted(), COUNT_TABLE)
    assert changed.count() == 2
    # The window at 200 is not complete yet, neither in the stream nor for corrections.
    assert stream.fixed(COUNT_TABLE, "count") == {("X", 0): 2, ("Y", 50): 1}
    stream.feed(counted, record(500), mode="append")
    assert stream.fix(corrections.counted(), COUNT_TABLE).count() == 0
    assert stream.fixed(COUNT_TABLE, "count") == {("X", 0): 2, ("Y", 50): 1, ("X", 200): 1, ("X", 210): 2}


def test_without_new_ticks_nothing_is_done(stream):
    stream.feed(counted, record(0), record(200), mode="append")
    assert stream.fix(corrections.counted(), COUNT_TABLE) is not None
    assert stream.fix(corrections.counted(), COUNT_TABLE) is None


def test_a_correction_that_was_lost_is_made_again(stream):
    stream.feed(counted, record(0), record(200), record(210), record(5), mode="append")
    first = sorted(map(tuple, stream.fix(corrections.counted(), COUNT_TABLE).collect()))
    before = stream.fixed(COUNT_TABLE, "count")
    tables.write_version(stream.spark.createDataFrame([], COUNT_TABLE), f"{stream.folder}/fixed", -1)
    done = max(tables.numbers(stream.spark, f"{stream.folder}/fixed", "batch_id"))
    tables._remove(stream.spark, f"{stream.folder}/fixed/batch_id={done}")
    assert sorted(map(tuple, stream.fix(corrections.counted(), COUNT_TABLE).collect())) == first
    assert stream.fixed(COUNT_TABLE, "count") == before


def test_means_over_midnight(stream):
    # The base time is 08:00; the late tick lies just before midnight, in windows of both days.
    midnight = 16 * 3600

    def means(topic, path, run):
        return jobs.run_means(topic, path, run)

    stream.feed(means, record(midnight + 1), record(midnight + 500), record(midnight - 2), record(midnight + 600), mode="append")
    assert stream.late > 0
    stream.fix(corrections.averaged(), MEAN_TABLE, 30)
    found = stream.fixed(MEAN_TABLE, "bid_points_avg")
    starts = {s for _, s in found if s < midnight + 100}
    assert starts == {float(s) for s in range(midnight - 30, midnight + 5, 5)}
