"""Decoding, typing, quarantine, ids and dates."""

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewatch.functions.ids import time_id
from ratewatch.functions import clock
from ratewatch.operators import latest, ticks
from ratewatch.schemas import BOUND_FIELDS, MEAN_FIELDS, WIRE_FIELDS

RECORD = (
    '{"fx_marker":"X","timestamp_ms":"1530000000123","bid_big":"1.1","bid_points":"5",'
    '"offer_big":"1.2","offer_points":"6","hight":"1.3","low":"1.0","open":"1.05"}'
)


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fields_are_typed_and_milliseconds_kept(spark):
    row = ticks.ticks_of(messages(spark, RECORD)).first()
    assert (row["bid_big"], row["bid_points"], row["open"]) == (1.1, 5, 1.05)
    assert row["ts"] == datetime.fromtimestamp(1530000000.123)


def test_binary_values_are_read(spark):
    raw = messages(spark, RECORD).select(F.encode("value", "UTF-8").alias("value"))
    assert ticks.ticks_of(raw).first()["fx_marker"] == "X"


def test_blank_lines_bad_json_and_missing_markers_are_dropped(spark):
    frame = f"\n{RECORD}\n\nnot json\n{{}}\n" + RECORD.replace('"X"', '""') + "\n" + RECORD.replace('"X"', "null")
    assert ticks.ticks_of(messages(spark, frame, "", "[]", "7")).count() == 1


def test_unreadable_numbers_become_null_in_streams(spark):
    bad = RECORD.replace('"1.1"', '""').replace('"5"', '"five"').replace("1530000000123", "soon")
    row = ticks.ticks_of(messages(spark, bad)).first()
    assert (row["bid_big"], row["bid_points"], row["ts"], row["open"]) == (None, None, None, 1.05)


def test_times_out_of_range_are_no_times(spark):
    far = [RECORD.replace("1530000000123", str(ms)) for ms in (10**17, -(10**17), 2**63 - 1, 10**30)]
    assert [r["ts"] for r in ticks.ticks_of(messages(spark, *far)).collect()] == [None] * 4


def test_only_named_fields_are_parsed(spark):
    rows = ticks.ticks_of(messages(spark, RECORD), MEAN_FIELDS)
    assert rows.columns == ["pos", *MEAN_FIELDS, "ts"]


def test_bounds_in_records_are_typed(spark):
    record = RECORD[:-1] + ',"stream_stat_min":"2","stream_stat_max":"x"}'
    row = ticks.ticks_of(messages(spark, record), (*WIRE_FIELDS, *BOUND_FIELDS)).first()
    assert (row["stream_stat_min"], row["stream_stat_max"]) == (2.0, None)


def test_one_bad_record_spoils_no_other(spark):
    bad = RECORD.replace('"5"', '"5.5"').replace('"1.0"', '"low"')
    raw = ticks.decode(messages(spark, RECORD, bad, "junk", RECORD))
    assert ticks.valid_ticks(raw).count() == 2
    assert [r["bad_fields"] for r in ticks.quarantined(raw).collect()] == [
        "bid_points,low",
        ",".join(WIRE_FIELDS),
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["1", "", "x", "1.5", " 2 ", None]), min_size=9, max_size=9), min_size=1, max_size=15))
def test_every_record_is_stored_or_quarantined(spark, rows):
    raw = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{f} string" for f in WIRE_FIELDS))
    assert ticks.valid_ticks(raw).count() + ticks.quarantined(raw).count() == len(rows)


def test_ids_agree_between_runs_unless_random(spark, make_ticks):
    rows = ticks.with_date(make_ticks(("X", 0, 1.0, 1), ("Y", 0, 1.0, 1)))
    first, again = (ticks.with_record_id(rows).select("record_id").collect() for _ in range(2))
    assert first == again and len(set(first)) == 2
    random = ticks.with_record_id(rows, random=True).first()["record_id"]
    assert len(random) == 36


def test_dates_are_utc(spark, make_ticks):
    midnight = 1_530_057_600_000 - 1_530_000_000_000
    rows = ticks.with_date(make_ticks(("X", midnight - 1, 1.0, 1), ("X", midnight, 1.0, 1)))
    assert [r["timestamp_d"] for r in rows.collect()] == [date(2018, 6, 26), date(2018, 6, 27)]


def test_new_york_clock_in_winter_and_summer(spark):
    at = F.col("t").cast("timestamp")
    rows = spark.createDataFrame([("2024-01-31 12:00:00",), ("2024-07-31 12:00:00",)], "t string")
    shown = rows.select(clock.new_york_clock(at).cast("string").alias("t")).collect()
    assert [r["t"] for r in shown] == ["2024-01-31 07:00:00", "2024-07-31 08:00:00"]
    assert rows.select(clock.new_york_clock().alias("t")).first()["t"] is not None


def test_recent_dates_are_the_two_end_dates():
    assert clock.recent_dates(3, date(2024, 3, 1)) == [date(2024, 2, 27), date(2024, 3, 1)]
    assert clock.recent_dates(0, date(2024, 3, 1)) == [date(2024, 3, 1)]


def test_latest_keeps_rows_whole(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1.0, None), ("a", 3, None, 7), ("a", 2, 9.0, 9), ("b", 1, None, None)],
        "k string, version bigint, x double, y int",
    )
    got = latest.latest(rows, ("k",), "version").select("k", "x", "y", "version").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", None, 7, 3), ("b", None, None, 1)]


def test_latest_by_several_columns(spark):
    rows = spark.createDataFrame([("a", 1, 9, "x"), ("a", 2, 1, "y"), ("a", 2, 0, "z")], "k string, o int, p int, v string")
    assert [tuple(r) for r in latest.latest(rows, ("k",), "o", "p").collect()] == [("a", "y")]


def test_latest_never_mixes_rows_of_one_version(spark):
    rows = spark.range(20000).selectExpr("id % 3 as k", "1L as version", "id as x", "id as y", "cast(id as double) as z")
    got = latest.latest(rows.repartition(8), ("k",), "version")
    assert got.where("x = y and x = z").count() == 3


def test_recent_per_marker_beyond_the_group_limit(spark):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('m', id % 2)) as m", "id")
    got = latest.recent_per(rows, 1500, "m", "id")
    counted = {r["m"]: (r["n"], r["low"]) for r in got.groupBy("m").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()}
    expected = {}
    for m in ("hot", "m0", "m1"):
        ids = sorted((i for i in range(9000) if ("hot" if i % 3 == 0 else f"m{i % 2}") == m), reverse=True)[:1500]
        expected[m] = (1500, ids[-1])
    assert counted == expected


def test_time_ids_sort_as_times_and_are_uuids_of_version_7(spark):
    import uuid

    times = [0, 1, 1_530_000_000_000, 1_530_000_000_001, 2**48 - 1]
    rows = spark.createDataFrame([("A", ms) for ms in [*times, -1, 2**48, None]], "fx_marker string, timestamp_ms bigint")
    made = rows.withColumn("id", time_id(F.col("timestamp_ms"), rows.schema, "fx_marker", "timestamp_ms"))
    ids = {r["timestamp_ms"]: r["id"] for r in made.collect()}
    assert [ids[ms] for ms in times] == sorted(ids[ms] for ms in times)
    for ms in times:
        read = uuid.UUID(ids[ms])
        assert read.version == 7 and read.variant == uuid.RFC_4122 and read.int >> 80 == ms
    assert ids[-1] is ids[2**48] is ids[None] is None
    again = made.select("id").collect()
    assert again == made.select("id").collect()


def test_rescued_fields(spark):
    odd = [
        RECORD,
        RECORD.replace('"1.1"', "1.1").replace("}", ',"venue":{"lots":[1,2.5]},"note":null}'),
        RECORD.replace('"5"', '{"a":1}').replace('"1.05"', "[1]").replace('"6"', "null"),
        RECORD.replace('"X"', '{"m":"X"}'),
        "not json", "[1]", '{"open":"1","open":"2"}', "{}", None, "",
    ]
    rows = messages(spark, *odd).withColumn("n", F.monotonically_increasing_id())
    got = {r["n"]: r for r in ticks.rescued(rows).collect()}
    got = [got[n] for n in sorted(got)]
    assert len(got) == len(odd)
    assert [r["rescued"] for r in got] == [
        None, '{"note":null,"venue":{"lots":[1,2.5]}}', '{"bid_points":{"a":1},"open":[1]}', '{"fx_marker":{"m":"X"}}',
        "not json", "[1]", '{"open":"1","open":"2"}', None, None, "",
    ]
    assert [r["fx_marker"] for r in got] == ["X"] * 3 + [None] * 7
    assert [(r["bid_big"], r["bid_points"], r["offer_points"], r["open"]) for r in got[:3]] == [
        (1.1, 5, 6, 1.05), (1.1, 5, 6, 1.05), (1.1, None, None, None)
    ]
    few = ticks.rescued(rows.limit(1), ("fx_marker",)).first()
    assert few["fx_marker"] == "X" and few["rescued"].startswith('{"bid_big":"1.1",')
