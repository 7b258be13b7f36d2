"""Windows, statistics, bounds and anomalies."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewatch.operators import counts, trends

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TICK = st.tuples(
    st.sampled_from(["A", "B"]),
    st.one_of(st.none(), st.integers(-100_000, 100_000)),
    st.one_of(st.none(), st.integers(0, 9).map(float)),
    st.one_of(st.none(), st.integers(0, 99)),
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def counted(spark, *values):
    schema = "fx_marker string, count bigint, stream_stat_min double, stream_stat_max double"
    return spark.createDataFrame(list(values), schema)


@QUICK
@given(st.lists(TICK, min_size=1, max_size=25))
def test_sums_per_slide_give_the_same_means(spark, make_ticks, values):
    ticks = make_ticks(*values)
    names = ("avg(bid_big)", "avg(bid_points)")
    got = trends.sliding_mean(ticks)
    want = ticks.groupBy(F.window("ts", "30 seconds", "5 seconds"), "fx_marker").mean("bid_big", "bid_points")

    def plain(df):
        chosen = df.select("fx_marker", F.col("window.start").cast("long"), *[F.coalesce(f"`{n}`", F.lit(-1.0)) for n in names])
        return rows(chosen)

    assert plain(got) == plain(want) == plain(trends.sliding_mean(ticks, sum_first=False))


@pytest.mark.parametrize("duration, slide", [(90, 5), (95, 7), (100, 9), (300, 1)])
@pytest.mark.parametrize("by", [("fx_marker",), ()])
def test_sums_per_stretch_give_the_same_means(spark, make_ticks, duration, slide, by):
    rng = random.Random(duration)
    values = [(rng.choice("AB"), rng.randint(-300_000, 300_000), float(rng.randint(0, 9)), rng.choice([None, 3, 7])) for _ in range(120)]
    # Such values must not reach beyond the windows they lie in.
    values += [("A", None, 1.0, 1), ("B", 900_000, float("inf"), 1), ("B", 901_000, float("nan"), 1), ("B", 901_500, 1e300, 1)]
    ticks = make_ticks(*values)

    def plain(df):
        means = [F.coalesce(F.round(f"`avg({c})`", 6), F.lit(-1.0)).cast("string") for c in ("bid_big", "bid_points")]
        return rows(df.select(*by, "window.start", "window.end", *means))

    got, want = (trends.sliding_mean(ticks, duration, slide, by=by, sum_first=first) for first in (True, False))
    assert plain(got) == plain(want)


def test_many_windows_a_tick_need_no_expansion(make_ticks):
    text = trends.sliding_mean(make_ticks(("A", 0, 1.0, 1)), 86_400, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "NestedLoop" not in text
    assert trends.sliding_mean(make_ticks(("A", 0, 1.0, 1)), 86_400, 10).count() == 8640


@QUICK
@given(st.lists(TICK, min_size=1, max_size=25))
def test_a_tick_is_in_six_sliding_windows_and_in_one_tumbling(spark, make_ticks, values):
    ticks = make_ticks(*values)
    timed = sum(v[1] is not None for v in values)
    assert ticks.groupBy(F.window("ts", "30 seconds", "5 seconds")).count().agg(F.sum("count")).first()[0] in (6 * timed, None)
    assert (counts.tumbling_count(ticks).agg(F.sum("count")).first()[0] or 0) == timed


def test_windows_start_on_whole_slides_and_end_open(spark, make_ticks):
    got = trends.flat(counts.tumbling_count(make_ticks(("A", 0, 1.0, 1), ("A", 9999, 1.0, 1), ("A", 10000, 1.0, 1))))
    starts = got.select(F.unix_millis("window_start") - 1_530_000_000_000, F.unix_millis("window_end") - 1_530_000_000_000, "count")
    assert rows(starts) == [(0, 10000, 2), (10000, 20000, 1)]


def test_a_slide_that_does_not_divide_the_duration(spark, make_ticks):
    got = trends.sliding_mean(make_ticks(("A", 0, 2.0, 1), ("A", 4000, 4.0, 2)), 10, 4)
    want = make_ticks(("A", 0, 2.0, 1), ("A", 4000, 4.0, 2)).groupBy(F.window("ts", "10 seconds", "4 seconds"), "fx_marker").mean("bid_big", "bid_points")
    assert rows(trends.flat(got)) == rows(trends.flat(want).select(*trends.flat(got).columns))


def test_mean_of_every_number(spark, make_ticks):
    got = trends.sliding_mean(make_ticks(("A", 0, 2.0, 1)), 5, 5, columns=None)
    assert got.columns == ["window", "fx_marker", "avg(timestamp_ms)", "avg(bid_big)", "avg(bid_points)"]


def test_sums_of_large_numbers_do_not_overflow(spark):
    rows = spark.range(4).selectExpr("'A' as fx_marker", "timestamp_seconds(id) as ts", "9000000000000000000L as n", "cast(1.5 as decimal(10,2)) as d")
    row = trends.sliding_mean(rows, 10, 5, columns=None).first()
    assert row["avg(n)"] == 9e18 and float(row["avg(d)"]) == 1.5


def test_ticks_of_one_time_can_count_once(spark, make_ticks):
    ticks = make_ticks(("A", 0, 1.0, 1), ("A", 0, 2.0, 1), ("B", 0, 1.0, 1), ("A", 5, 1.0, 1))
    assert rows(counts.tumbling_count(ticks).select("fx_marker", "count")) == [("A", 3), ("B", 1)]
    assert rows(counts.tumbling_count(ticks, dedup=True).select("fx_marker", "count")) == [("A", 2), ("B", 1)]


def test_statistics_use_the_sample_deviation(spark, make_ticks):
    ticks = make_ticks(*[("A", ms, 1.0, 1) for ms in (0, 1, 2, 10000)], ("B", 0, 1.0, 1))
    ticks = ticks.withColumn("timestamp_d", F.to_date("ts"))
    stats = counts.all_statistics(ticks, ["2018-06-26"])
    got = rows(stats.select("fx_marker", "avg_count", F.round("stddev_count", 6)).na.fill(-1.0))
    assert got == [("A", 2.0, 1.414214), ("B", 1.0, -1.0)]
    one = counts.marker_statistics(ticks, "A", ["2018-06-26", "2018-06-30"]).first()
    assert (one["fx_marker"], one["avg_count"]) == ("A", 2.0)
    none = counts.marker_statistics(ticks, "A", ["2018-06-30"]).first()
    assert (none["avg_count"], none["stddev_count"]) == (None, None)


def test_bounds_are_strict_and_a_null_bound_never_fires(spark):
    given_counts = counted(
        spark, ("low", 3, 4.0, 6.0), ("edge", 4, 4.0, 6.0), ("top", 6, 4.0, 6.0), ("high", 7, 4.0, 6.0),
        ("none", 7, None, None), ("no_low", 1, None, 6.0), ("no_low_high", 7, None, 6.0), ("no_high", 1, 4.0, None),
    )
    fired = {r["fx_marker"] for r in given_counts.where(counts.outside()).collect()}
    assert fired == {"low", "high", "no_low_high", "no_high"}


def test_markers_without_statistics_raise_no_alarm(spark, make_ticks):
    found = counts.tumbling_count(make_ticks(("A", 0, 1.0, 1), ("B", 0, 1.0, 1), ("C", 0, 1.0, 1)))
    limits = spark.createDataFrame(
        [("A", 2.0, 3.0), ("B", None, None)], "fx_marker string, stream_stat_min double, stream_stat_max double"
    )
    assert rows(counts.anomalies(found, limits).select("fx_marker", "count")) == [("A", 1)]
    assert rows(counts.flagged(found, limits).select("fx_marker", "is_anomaly")) == [("A", True), ("B", False)]


def test_bounds_follow_k(spark):
    stats = spark.createDataFrame([("A", 10.0, 2.0), ("B", 10.0, None)], "fx_marker string, avg_count double, stddev_count double")
    got = [tuple(r) for r in counts.bounds(stats, 3).orderBy("fx_marker").collect()]
    assert got == [("A", 4.0, 16.0), ("B", None, None)]
