"""Ticks in intervals of any length."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratewatch.operators.intervals import within
from ratewatch.plans.queries import QUERIES

BASE = 1_530_000_000_000


def made(spark, *spans):
    rows = [(n, m, None if a is None else BASE + a, None if b is None else BASE + b) for n, (m, a, b) in enumerate(spans)]
    frame = spark.createDataFrame(rows, "number int, fx_marker string, a bigint, b bigint")
    times = F.timestamp_millis("a").alias("window_start"), F.timestamp_millis("b").alias("window_end")
    return frame.select("number", "fx_marker", *times)


def numbered(make_ticks, values):
    return make_ticks(*[(m, ms, float(n), 0) for n, (m, ms) in enumerate(values)])


def by_hand(ticks, spans, how, by_marker=True):
    out = []
    for n, (m, ms) in enumerate(ticks):
        held = [
            k for k, (other, a, b) in enumerate(spans)
            if None not in (ms, a, b) and a <= ms < b and (not by_marker or m == other)
        ]
        out += [(n, k) for k in held] or ([(n, None)] if how == "left" else [])
    return sorted(out, key=str)


def found(joined):
    return sorted(((int(r["bid_big"]), r["number"]) for r in joined.collect()), key=str)


RNG = random.Random(8)
TICKS = [(RNG.choice("AB"), RNG.choice([None, *[RNG.randint(-300_000, 300_000)] * 9])) for _ in range(120)]
LENGTHS = [0, -5, 1, 999, 1000, 1001, 8000, 8001, 60_000, 500_000]
SPANS = [(RNG.choice(["A", "B", None]), a := RNG.randint(-300_000, 300_000), a + RNG.choice(LENGTHS)) for _ in range(70)]
SPANS += [("A", None, 5), ("A", 5, None), SPANS[0]]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("by", [("fx_marker",), ()])
@pytest.mark.parametrize("spans", [SPANS, SPANS[:1], [("A", 0, 1000), ("A", 1000, 2000)], [("B", 7, 7)]])
def test_any_intervals(spark, make_ticks, how, by, spans):
    joined = within(numbered(make_ticks, TICKS), made(spark, *spans), by=by, how=how, parts=1 if by else 3)
    assert found(joined) == by_hand(TICKS, spans, how, bool(by))


def test_start_is_in_and_end_is_not(spark, make_ticks):
    ticks = [("A", 0), ("A", 999), ("A", 1000), ("A", -1)]
    assert found(within(numbered(make_ticks, ticks), made(spark, ("A", 0, 1000)), how="inner")) == [(0, 0), (1, 0)]


def test_columns(spark, make_ticks):
    ticks = numbered(make_ticks, TICKS).withColumn("_level", F.lit("x")).withColumn("_bin", F.lit("y"))
    joined = within(ticks, made(spark, *SPANS))
    assert joined.columns == [*ticks.columns, "number", "window_start", "window_end"]
    assert {(r["_level"], r["_bin"]) for r in joined.collect()} == {("x", "y")}


def test_a_marker_with_most_ticks_is_dealt_over_its_bins(spark, make_ticks):
    ticks = numbered(make_ticks, [("A", second * 1000) for second in range(3000)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = within(ticks, made(spark, *[("A", s * 1000, s * 1000 + 20_000) for s in range(0, 3000, 10)]), how="inner")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "_bin" in text.split("hashpartitioning(")[1]
        sizes = joined.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert sum(sizes) == 6000 - 10 and max(sizes) < 0.6 * sum(sizes) and min(sizes) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("by", [("fx_marker",), ()])
@pytest.mark.parametrize("spans", [SPANS, SPANS[:1], [("A", 0, 1000), ("A", 1000, 2000)], [("B", 7, 7)]])
def test_rows_are_counted_in_any_intervals(spark, make_ticks, by, spans):
    odd = F.when(F.col("bid_big") % 3 != 0, F.col("bid_big") % 2)
    ticks = numbered(make_ticks, TICKS + TICKS[:40]).withColumn("odd", odd)
    joined = within(ticks, made(spark, *spans), by=by, how="inner", parts=1 if by else 3, per=("odd",))
    assert joined.columns == ["number", "fx_marker", "window_start", "window_end", "odd", "n"]
    wanted = Counter(
        (k, n % 2 if n % 3 else None) for n, k in by_hand(TICKS + TICKS[:40], spans, "inner", bool(by))
    )
    got = [((r["number"], r["odd"]), r["n"]) for r in joined.collect()]
    assert len(got) == len(wanted) and dict(got) == wanted


def test_ticks_after_purchase_lists_no_pairs(spark, sf):
    """What joins give grows with purchases and markers, and not with the ticks of each purchase."""
    text = QUERIES["ticks_after_purchase"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "_before" in text and "_bin" not in text


def test_counts_are_for_inner_only(spark, make_ticks):
    with pytest.raises(ValueError):
        within(numbered(make_ticks, TICKS), made(spark, *SPANS), per=())
