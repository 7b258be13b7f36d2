"""The registered queries: each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.functions.clock import recent_dates
from ratewatch.functions.ids import time_id
from ratewatch.operators import counts, daily, envelope, framing, intervals, latest, serving, silence, ticks, trends
from ratewatch.plans.replay import replay
from ratewatch.schemas import (
    ANOMALY_TABLE,
    BOUND_FIELDS,
    COUNT_FIELDS,
    COUNT_TABLE,
    DAY_KEY,
    DAY_TABLE,
    MEAN_TABLE,
    QUOTE_TYPES,
    RESULT_KEY,
    TICK_KEY,
    TICK_TABLE,
    WIRE_FIELDS,
)
from ratewatch.session import configure, run_folder, stored
from ratewatch.sources import events, lines, tables
from ratewatch.sources.messages import append_topic, read_topic
from ratewatch.streaming import corrections, jobs, sinks
from ratewatch.streaming.runner import Run

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3600
MARKER = "click"
TWO_MARKERS = ["click", "view"]
BASE_DATES = ["2024-01-01", "2024-01-02", "2024-01-03"]
SERVED_DATES = recent_dates(1, date(2024, 1, 30))
LATE = (datetime(2024, 1, 11), datetime(2024, 1, 21))
NUMBERS = [name for name, kind in QUOTE_TYPES.items() if kind in ("double", "int")]
AS_OF = "2024-01-31 12:00:00"
RECENT = 100
MANY = 2000
REPORT_DATES = ["2024-01-01", "2024-01-02"]
TEN_MINUTES = 600
FIVE_MINUTES = 300
NARROW = 1.0
HIGH_MEAN = 55

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _plain(rows: DataFrame) -> DataFrame:
    """Timestamps without zone and dates as text, as the comparison expects them."""
    compared = {"timestamp": "timestamp_ntz", "date": "string"}
    return rows.select(
        *[F.col(f"`{c}`").cast(compared.get(t, t)).alias(c) for c, t in rows.dtypes]
    )


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _tick_columns(rows: DataFrame) -> DataFrame:
    return _plain(rows.select("event_id", *WIRE_FIELDS, "ts"))


# Records, lines and typing


@register
def ticks_of_events(spark: SparkSession, sf: str) -> DataFrame:
    return _tick_columns(events.ticks(spark, sf))


@register
def wire_parse(spark: SparkSession, sf: str) -> DataFrame:
    return framing.parse_lines(events.quote_lines(spark, sf))


@register
def wire_files(spark: SparkSession, sf: str) -> DataFrame:
    """Quote lines from text files."""
    path = run_folder(configure(spark), "lines")
    events.quote_lines(spark, sf).select("value").write.text(path)
    return framing.parse_lines(lines.quote_lines(spark, path))


@register
def wire_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = framing.quarantine_lines(events.quote_lines(spark, sf))
    return rows.select("event_id", F.col("value").alias("line"), "n_fields")


@register
def ticks_from_json(spark: SparkSession, sf: str) -> DataFrame:
    records = framing.record_json(framing.parse_lines(events.quote_lines(spark, sf)))
    return _tick_columns(ticks.typed(ticks.with_marker(ticks.decode(records))))


@register
def frame_single_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each line as a response of its own: no message where the line is incomplete."""
    return framing.frame_responses(events.quote_lines(spark, sf)).select("event_id")


@register
def frame_sizes(spark: SparkSession, sf: str) -> DataFrame:
    messages = framing.frame_responses(events.quote_responses(spark, sf))
    return framing.unframe(messages).groupBy("offset").agg(F.count("*").alias("records"))


@register
def frame_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    messages = framing.frame_responses(events.quote_responses(spark, sf))
    return _plain(ticks.ticks_of(messages).select(*WIRE_FIELDS, "ts"))


@register
def ticks_valid(spark: SparkSession, sf: str) -> DataFrame:
    return _tick_columns(ticks.valid_ticks(events.raw_records(spark, sf)))


@register
def ticks_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = ticks.quarantined(events.raw_records(spark, sf))
    return bad.select("event_id", "fx_marker", "timestamp_ms", "bid_points", "bad_fields")


@register
def ticks_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Records with fields that the schema does not know, or of another kind, lose nothing."""
    rows = ticks.rescued(events.odd_records(spark, sf)).withColumn("bid_points", F.col("bid_points").cast("double"))
    return _plain(rows.select("event_id", *WIRE_FIELDS, "ts", "rescued"))


@register
def ticks_with_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = ticks.with_record_id(events.ticks(spark, sf), ("fx_marker", "timestamp_ms"))
    return rows.select("event_id", "record_id")


@register
def ticks_with_time_id(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that sort as the times of the ticks."""
    rows = events.ticks(spark, sf)
    made = time_id(F.col("timestamp_ms"), rows.schema, "fx_marker", "timestamp_ms")
    return rows.select("event_id", made.alias("time_id"))


@register
def ticks_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf).withColumn("hour", F.floor(F.col("timestamp_ms") / 3_600_000))
    return _plain(latest.latest(rows.drop("timestamp_d"), ("fx_marker", "hour"), "event_id"))


@register
def ticks_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """All ticks, then error ticks and last views again; compacted after the first and second."""
    folder = run_folder(configure(spark), "versions")

    def last(rows: DataFrame) -> DataFrame:
        return latest.latest(rows, (*TICK_KEY, "ts"), "event_id").select(*TICK_TABLE.names)

    table, packed = f"{folder}/ticks", f"{folder}/packed"
    tables.write_version(last(events.ticks(spark, sf)), table, 0)
    for batch, marker in ((1, "error"), (2, "view")):
        tables.compact(spark, table, packed, TICK_TABLE, TICK_KEY)
        again = events.ticks(spark, sf, [marker]).withColumn("bid_points", F.lit(-batch))
        tables.write_version(last(again), table, batch)
    tables.prune(spark, table, packed, keep=-1)
    now = tables.read_latest(spark, table, TICK_TABLE, TICK_KEY, compacted=packed, record_id=True)
    return _plain(now.select("fx_marker", "timestamp_ms", "bid_points", "open", "batch_id", "record_id"))


# Windows


@register
def tumbling_count(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trends.flat(counts.tumbling_count(events.ticks(spark, sf))))


@register
def tumbling_count_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trends.flat(counts.tumbling_count(events.ticks(spark, sf), HOUR)))


@register
def tumbling_count_marker(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf, markers=TWO_MARKERS)
    return _plain(trends.flat(counts.tumbling_count(rows, HOUR)))


@register
def tumbling_count_distinct_times(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf).withColumn("ts", F.date_trunc("minute", "ts"))
    return _plain(trends.flat(counts.tumbling_count(rows, 24 * HOUR, dedup=True)))


@register
def sliding_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trends.mean_rows(trends.sliding_mean(events.ticks(spark, sf))))


@register
def sliding_mean_hours(spark: SparkSession, sf: str) -> DataFrame:
    means = trends.sliding_mean(events.ticks(spark, sf), 6 * HOUR, HOUR)
    return _plain(trends.mean_rows(means))


@register
def sliding_mean_all_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Means of all numbers, rounded as sums of sums differ in the last bit from plain sums."""
    rows = events.ticks(spark, sf).select("fx_marker", "ts", *NUMBERS)
    means = trends.flat(trends.sliding_mean(rows, 6 * HOUR, HOUR, columns=None))
    named = {c: c[4:-1] + "_avg" for c in means.columns if "(" in c}
    return _plain(means.withColumnsRenamed(named)).withColumns({c: F.round(c, 6) for c in named.values()})


@register
def sliding_mean_day(spark: SparkSession, sf: str) -> DataFrame:
    """Means of a day, one every five minutes: 288 windows hold a tick."""
    means = trends.sliding_mean(events.ticks(spark, sf), 24 * HOUR, FIVE_MINUTES)
    return _plain(trends.mean_rows(means))


def _with_silent(spark: SparkSession, sf: str, duration: int) -> DataFrame:
    found = stored(counts.tumbling_count(events.ticks(spark, sf), duration), "counts")
    return silence.with_silent(found, duration)


@register
def tumbling_count_silent(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of ten minutes, with a row of 0 for those without ticks."""
    return _plain(trends.flat(_with_silent(spark, sf, TEN_MINUTES)))


# Statistics, bounds and anomalies


def _rounded(stats: DataFrame) -> DataFrame:
    return _plain(stats).withColumns(
        {c: F.round(c, 6) for c in ("avg_count", "stddev_count") if c in stats.columns}
    )


def _base_statistics(spark: SparkSession, sf: str) -> DataFrame:
    history = events.ticks(spark, sf, dates=BASE_DATES)
    return counts.all_statistics(history, BASE_DATES, HOUR, _as_of())


def _hour_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.tumbling_count(events.ticks(spark, sf), HOUR)


def _hour_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    limits = counts.bounds(_base_statistics(spark, sf))
    return counts.anomalies(_hour_counts(spark, sf), limits)


def _served_table(spark: SparkSession, rows: DataFrame, schema, name: str) -> DataFrame:
    """Results written once by marker and date, as the serving queries read them."""
    path = run_folder(configure(spark), name)
    tables.write_table(rows.select(*schema.names), path, "window_start", "overwrite")
    return tables.read_table(spark, path, schema)


def _anomaly_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = envelope.decode_anomalies(envelope.encode(_hour_anomalies(spark, sf)))
    return _served_table(spark, rows, ANOMALY_TABLE, "anomalies")


def _mean_table(spark: SparkSession, sf: str) -> DataFrame:
    means = trends.mean_rows(trends.sliding_mean(events.ticks(spark, sf), 6 * HOUR, HOUR))
    return _served_table(spark, means.withColumn("timestamp_d", F.to_date("window_start")), MEAN_TABLE, "means")


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    """The ticks that the dashboard shows."""
    rows = events.ticks(spark, sf, [MARKER], SERVED_DATES)
    return serving.recent_ticks(rows, MARKER, SERVED_DATES, RECENT, "event_id")


@register
def baseline_one_marker(spark: SparkSession, sf: str) -> DataFrame:
    dates = BASE_DATES[:2]
    history = events.ticks(spark, sf, [MARKER], dates)
    return _rounded(counts.marker_statistics(history, MARKER, dates, as_of=_as_of()))


@register
def baseline_per_marker(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_base_statistics(spark, sf))


@register
def baseline_stored_history(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of one marker from a partitioned table, of which two partitions are read."""
    path = run_folder(configure(spark), "ticks")
    tables.write_table(events.ticks(spark, sf).select(*TICK_TABLE.names), path)
    history = tables.read_table(spark, path, TICK_TABLE)
    dates = BASE_DATES[:2]
    return _rounded(counts.marker_statistics(history, MARKER, dates, HOUR, as_of=_as_of()))


@register
def count_bounds(spark: SparkSession, sf: str) -> DataFrame:
    limits = counts.bounds(_base_statistics(spark, sf))
    return limits.withColumns({c: F.round(c, 6) for c in BOUND_FIELDS})


@register
def latest_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics gathered once for each day, appended to their table; the last are kept."""
    daily = counts.tumbling_count(events.ticks(spark, sf), HOUR)
    days = daily.withColumn("day", F.to_date("window.start"))
    noon = F.to_timestamp(F.concat_ws(" ", F.col("day"), F.lit("12:00:00")))
    runs = counts.statistics(days, "fx_marker", "day", as_of=noon)
    path = run_folder(spark, "statistics")
    tables.append_statistics(runs, path)
    return _rounded(tables.newest_statistics(spark, path))


@register
def anomalies_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trends.flat(_hour_anomalies(spark, sf)))


@register
def anomalies_silent(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies of ten minutes where windows without ticks count as 0, in the statistics, too."""
    found = _with_silent(spark, sf, TEN_MINUTES)
    base = counts.on_dates(found.withColumn("day", F.to_date("window.start")), BASE_DATES, "day")
    limits = counts.bounds(counts.statistics(base, "fx_marker", as_of=_as_of()), NARROW)
    return _plain(trends.flat(counts.anomalies(found, limits)))


@register
def baseline_merged_days(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics merged from sums by day; the sums of some days are gathered a second time."""
    path = run_folder(configure(spark), "days")
    for dates in (None, BASE_DATES[1:]):
        found = counts.tumbling_count(events.ticks(spark, sf, dates=dates), HOUR)
        tables.write_days(daily.day_sums(found), path)
    sums = tables.read_table(spark, path, DAY_TABLE)
    return _rounded(daily.merged_statistics(sums, BASE_DATES, _as_of()))


@register
def anomalies_in_message(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds that come with the records; views have none and so raise no alarm."""
    low = F.when(F.col("fx_marker") != "view", "2").alias(BOUND_FIELDS[0])
    high = F.when(F.col("fx_marker") != "view", "4").alias(BOUND_FIELDS[1])
    rows = events.ticks(spark, sf).select("*", low, high)
    fields = (*COUNT_FIELDS, *BOUND_FIELDS)
    records = framing.record_json(rows.select(*fields), fields)
    typed = ticks.typed(ticks.with_marker(ticks.decode(records, fields)))
    return _plain(trends.flat(counts.anomalies_in_message(typed, HOUR)))


# Result messages


@register
def envelope_avg_decode(spark: SparkSession, sf: str) -> DataFrame:
    means = trends.sliding_mean(events.ticks(spark, sf), 6 * HOUR, HOUR)
    return _plain(envelope.decode_means(envelope.encode(means)))


@register
def envelope_anomaly_decode(spark: SparkSession, sf: str) -> DataFrame:
    rows = envelope.decode_anomalies(envelope.encode(_hour_anomalies(spark, sf)))
    return _plain(ticks.with_record_id(rows, RESULT_KEY)).drop("is_anomaly")


# Serving


@register
def recent_ticks(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf, [MARKER], SERVED_DATES)
    top = serving.recent_ticks(rows, MARKER, SERVED_DATES, RECENT, "event_id")
    return _plain(top.select("event_id", "ts", "bid_points"))


@register
def recent_means(spark: SparkSession, sf: str) -> DataFrame:
    top = serving.recent_results(_mean_table(spark, sf), MARKER, SERVED_DATES, RECENT)
    return _plain(top.select("window_start", "bid_points_avg"))


@register
def recent_ticks_per_marker(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf).select("event_id", "fx_marker", "ts", "bid_points")
    return _plain(latest.recent_per(rows, RECENT, "fx_marker", "ts", "event_id"))


@register
def recent_ticks_many(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf).select("event_id", "fx_marker", "ts", "bid_points")
    return _plain(latest.recent_per(rows, MANY, "fx_marker", "ts", "event_id"))


@register
def anomaly_report(spark: SparkSession, sf: str) -> DataFrame:
    """The newest anomalies of one marker on two dates."""
    found = serving.of_marker(_anomaly_table(spark, sf), MARKER, REPORT_DATES)
    return _plain(serving.report(found.select("fx_marker", "window_start", "window_end", "anomaly_count"), 10))


@register
def anomalies_since_recent(spark: SparkSession, sf: str) -> DataFrame:
    found = serving.of_marker(_anomaly_table(spark, sf), MARKER, SERVED_DATES)
    return _plain(serving.since(found, _shown(spark, sf))).drop("is_anomaly")


@register
def means_since_recent(spark: SparkSession, sf: str) -> DataFrame:
    found = serving.of_marker(_mean_table(spark, sf), MARKER, SERVED_DATES)
    return _plain(serving.since(found, _shown(spark, sf)))


@register
def ticks_in_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    rows = events.ticks(spark, sf).select("event_id", "fx_marker", "ts", "bid_points")
    return _plain(serving.overlay(rows, _anomaly_table(spark, sf), HOUR))


@register
def ticks_in_high_means(spark: SparkSession, sf: str) -> DataFrame:
    """Every tick with each of the overlapping windows of six hours around it whose mean is high."""
    rows = events.ticks(spark, sf).select("event_id", "fx_marker", "ts")
    high = _mean_table(spark, sf).where(F.col("bid_points_avg") >= HIGH_MEAN)
    return _plain(intervals.within(rows, high.select("fx_marker", "window_start", "window_end")))


@register
def ticks_after_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks of each marker in the minutes after a purchase, as many minutes as it has points."""
    rows = events.ticks(spark, sf).select("fx_marker", "ts")
    bought = events.ticks(spark, sf, ["purchase"])
    minutes = F.make_dt_interval(mins=F.col("bid_points"))
    after = stored(bought.select("event_id", F.col("ts").alias("begin"), (F.col("ts") + minutes).alias("stop")), "after")
    found = intervals.within(
        rows, after, by=(), start="begin", end="stop", how="inner", parts=4, per=("fx_marker",)
    )
    return found.groupBy("event_id", "fx_marker").agg(F.sum("n").alias("ticks"))


# Streams


def _run(folder: str, mode: str = "update") -> Run:
    return Run(f"{folder}/checkpoint", mode, once=True)


def _table(spark: SparkSession, folder: str, schema, keys=RESULT_KEY) -> DataFrame:
    rows = tables.read_latest(spark, f"{folder}/table", schema, keys)
    return _plain(rows.select(*schema.names))


@register
def stream_sliding_mean(spark: SparkSession, sf: str) -> DataFrame:
    folder = replay(spark, sf, lambda messages, at: jobs.run_means(messages, f"{at}/table", _run(at)))
    return _table(spark, folder, MEAN_TABLE)


@register
def stream_tumbling_count(spark: SparkSession, sf: str) -> DataFrame:
    folder = replay(
        spark, sf, lambda messages, at: jobs.run_counts(messages, f"{at}/table", _run(at), duration=HOUR)
    )
    return _table(spark, folder, COUNT_TABLE)


@register
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The middle of the time comes last, far behind the watermark, and is left out."""
    one, two = LATE
    folder = replay(
        spark,
        sf,
        lambda messages, at: jobs.run_counts(messages, f"{at}/table", _run(at), duration=HOUR),
        slices=[(None, one), (two, None), (one, two)],
    )
    return _table(spark, folder, COUNT_TABLE)


def _late(spark: SparkSession, sf: str, start) -> str:
    """Ticks stored and results computed, slice by slice, the middle of the time last."""

    def both(messages: DataFrame, at: str):
        run = Run(f"{at}/checkpoint-ticks", "append", once=True)
        jobs.run_store_ticks(messages, f"{at}/ticks", f"{at}/bad", run).awaitTermination()
        return start(messages, at)

    one, two = LATE
    return replay(spark, sf, both, slices=[(None, one), (two, None), (one, two)])


@register
def stream_late_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of ``stream_late_rows``, corrected from the table of ticks while it runs and after."""

    def fix(at: str) -> None:
        again = corrections.counted(HOUR)
        corrections.correct(spark, f"{at}/ticks", f"{at}/table", f"{at}/fixed", again, COUNT_TABLE, HOUR)

    def start(messages: DataFrame, at: str):
        query = jobs.run_counts(messages, f"{at}/table", _run(at), duration=HOUR, dedup=True)
        query.awaitTermination()
        fix(at)
        return query

    folder = _late(spark, sf, start)
    fixed = corrections.read_corrected(spark, f"{folder}/table", f"{folder}/fixed", COUNT_TABLE)
    return _plain(fixed)


@register
def stream_late_means_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding means where the middle of the time comes last, corrected once at the end."""
    sizes = {"duration": 6 * HOUR, "slide": HOUR}
    folder = _late(spark, sf, lambda messages, at: jobs.run_means(messages, f"{at}/table", _run(at), **sizes))
    again = corrections.averaged(**sizes)
    paths = (f"{folder}/{name}" for name in ("ticks", "table", "fixed"))
    corrections.correct(spark, *paths, again, MEAN_TABLE, 6 * HOUR)
    return _plain(corrections.read_corrected(spark, f"{folder}/table", f"{folder}/fixed", MEAN_TABLE))


@register
def stream_silent_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies of a stream of one hour, where a marker without ticks counts as 0."""
    limits = stored(counts.bounds(_base_statistics(spark, sf), NARROW), "bounds")

    def start(messages: DataFrame, at: str):
        run = _run(at, "append")
        return jobs.run_anomalies(messages, limits, f"{at}/table", run, duration=HOUR, silent=True)

    folder = replay(spark, sf, start, close=True)
    return _table(spark, folder, ANOMALY_TABLE).drop("is_anomaly")


@register
def stream_day_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics merged from the sums by day that a stream keeps."""
    folder = replay(
        spark,
        sf,
        lambda messages, at: jobs.run_day_sums(messages, f"{at}/table", _run(at, "append"), duration=HOUR),
        close=True,
    )
    sums = tables.read_latest(spark, f"{folder}/table", DAY_TABLE, DAY_KEY)
    return _rounded(daily.merged_statistics(sums, BASE_DATES, _as_of()))


@register
def stream_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Complete windows judged against the statistics last stored."""
    path = run_folder(configure(spark), "statistics")
    tables.append_statistics(_base_statistics(spark, sf), path)

    def start(messages: DataFrame, at: str):
        limits = counts.bounds(tables.newest_statistics(spark, path))
        return jobs.run_anomalies(messages, limits, f"{at}/table", _run(at, "append"), duration=HOUR)

    folder = replay(spark, sf, start, close=True)
    return _table(spark, folder, ANOMALY_TABLE).drop("is_anomaly")


def _store_mixed(spark: SparkSession, sf: str) -> str:
    """Ticks whose ``bid_points`` cannot always be read, several to a message, stored."""
    return replay(
        spark,
        sf,
        lambda messages, at: jobs.run_store_ticks(messages, f"{at}/table", f"{at}/quarantine", _run(at)),
        frame=events.RESPONSE_LINES,
        records=lambda rows: events.unreadable(rows),
    )


@register
def stream_store_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, _store_mixed(spark, sf), TICK_TABLE, TICK_KEY)


@register
def stream_store_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream of ``stream_store_ticks`` sets aside."""
    rows = spark.read.parquet(f"{_store_mixed(spark, sf)}/quarantine")
    return rows.select("fx_marker", "timestamp_ms", "bid_points", "bad_fields")


@register
def stream_anomalies_update(spark: SparkSession, sf: str) -> DataFrame:
    """Windows judged while they fill; later versions take early alarms back."""
    limits = stored(counts.bounds(_base_statistics(spark, sf)), "bounds")
    folder = replay(
        spark,
        sf,
        lambda messages, at: jobs.run_anomalies(messages, limits, f"{at}/table", _run(at), duration=HOUR),
    )
    return _table(spark, folder, ANOMALY_TABLE).where("is_anomaly").drop("is_anomaly")


@register
def stream_means_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Means published to a topic, and stored from there by a second stream."""

    def start(messages: DataFrame, at: str):
        means = jobs.mean_messages(messages, 6 * HOUR, HOUR)
        jobs.run_publish_results(means, f"{at}/means", _run(at)).awaitTermination()
        published = read_topic(spark, f"{at}/means", stream=True)
        run = Run(f"{at}/checkpoint-store", "append", once=True)
        return jobs.run_store_results(published, f"{at}/table", run, "means")

    return _table(spark, replay(spark, sf, start), MEAN_TABLE)


@register
def stream_publish_store(spark: SparkSession, sf: str) -> DataFrame:
    """Text files, a later poll of which corrects the purchases, published and stored.

    Error events have a field too few and are set aside.
    """
    folder = run_folder(configure(spark), "polls")
    first = events.quote_lines(spark, sf).select("value")
    again = events.ticks(spark, sf, ["purchase"]).withColumn("bid_points", F.lit(0))
    fields = [F.col(name).cast("string") for name in WIRE_FIELDS]
    for poll in (first, again.select(F.concat_ws(",", *fields).alias("value"))):
        poll.write.mode("append").text(f"{folder}/text")
        responses = lines.quote_responses(spark, f"{folder}/text", stream=True)
        run = Run(f"{folder}/publish", "append", once=True)
        jobs.run_publish(responses, f"{folder}/topic", run).awaitTermination()
        topic = read_topic(spark, f"{folder}/topic", stream=True)
        run = Run(f"{folder}/store", "append", once=True)
        jobs.run_store_ticks(topic, f"{folder}/table", f"{folder}/bad", run).awaitTermination()
    return _table(spark, folder, TICK_TABLE, TICK_KEY)


# Results that lack a field, or are none at all; nothing of them is stored.
BROKEN = ['{"fx_marker":"click","count":3}', '{"window":{},"fx_marker":"view","count":1}', "junk", ""]


@register
def stream_anomalies_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies published to a topic, among broken messages, and stored by a second stream.

    The first stream starts a batch as soon as the last is done, the second every second.
    """
    limits = stored(counts.bounds(_base_statistics(spark, sf)), "bounds")

    def start(messages: DataFrame, at: str):
        write = sinks.publish(f"{at}/anomalies", key="key")
        run = Run(f"{at}/checkpoint", "append")
        judging = jobs.run_judged(messages, limits, write, run, duration=HOUR)
        judging.processAllAvailable()
        judging.stop()
        broken = spark.createDataFrame([(None, text.encode()) for text in BROKEN], "key string, value binary")
        append_topic(broken, f"{at}/anomalies")
        published = read_topic(spark, f"{at}/anomalies", stream=True)
        run = Run(f"{at}/checkpoint-store", "append", every="1 second")
        storing = jobs.run_store_results(published, f"{at}/table", run, "anomalies")
        storing.processAllAvailable()
        storing.stop()
        return storing

    folder = replay(spark, sf, start, close=True)
    return _table(spark, folder, ANOMALY_TABLE).drop("is_anomaly")


@register
def stream_stored_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated ticks stored, statistics gathered from the table, the stream judged by them."""
    folder = run_folder(configure(spark), "gathered")
    again = events.ticks(spark, sf).unionAll(events.ticks(spark, sf))
    keyed = latest.latest(again, (*TICK_KEY, "ts"), "event_id").select(*TICK_TABLE.names)
    tables.write_version(keyed, f"{folder}/ticks", 0)
    history = tables.read_latest(spark, f"{folder}/ticks", TICK_TABLE, TICK_KEY)
    tables.append_statistics(counts.all_statistics(history, BASE_DATES, HOUR, _as_of()), f"{folder}/statistics")

    def start(messages: DataFrame, at: str):
        limits = counts.bounds(tables.newest_statistics(spark, f"{folder}/statistics"))
        run = _run(at, "append")
        return jobs.run_anomalies(messages, limits, f"{at}/table", run, duration=HOUR, dedup=True)

    twice = replay(spark, sf, start, close=True, records=lambda rows: rows.unionAll(rows))
    return _table(spark, twice, ANOMALY_TABLE).drop("is_anomaly")


@register
def stream_bounded_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A backlog of many files counted by runs that take two files a batch.

    The watermark waits for the whole backlog, as the files are in no order of time.
    """
    folder = run_folder(configure(spark), "backlog")
    append_topic(events.messages(events.ticks(spark, sf)), f"{folder}/topic", partitions=12)
    topic = read_topic(spark, f"{folder}/topic", stream=True, most=2)
    run = _run(folder)
    jobs.run_counts(topic, f"{folder}/table", run, duration=HOUR, watermark=60 * 24 * HOUR).awaitTermination()
    return _table(spark, folder, COUNT_TABLE)


@register
def recent_ticks_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The newest ticks of one marker from a stored table of all dates, of which few are read."""
    path = run_folder(configure(spark), "ticks")
    tables.write_table(events.ticks(spark, sf).select(*TICK_TABLE.names), path)
    rows = serving.of_markers(tables.read_table(spark, path, TICK_TABLE), MARKER)
    dates = [date(2024, 1, day) for day in range(1, 31)]
    near = tables.newest_dates(rows, dates, RECENT)
    return _plain(serving.recent_ticks(rows, MARKER, near, RECENT, "open").select("ts", "bid_points", "open"))


@register
def stream_recent_view(spark: SparkSession, sf: str) -> DataFrame:
    """The served view of the newest ticks of every marker."""
    folder = replay(
        spark,
        sf,
        lambda messages, at: jobs.run_store_ticks(
            messages, f"{at}/table", f"{at}/quarantine", _run(at), f"{at}/view", RECENT
        ),
    )
    view = sinks.read_view(spark, f"{folder}/view", TICK_TABLE)
    return _plain(view.select("fx_marker", "ts", "bid_points"))
