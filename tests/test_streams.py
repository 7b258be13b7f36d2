"""Hand-made streams: one message per micro-batch."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ratewatch.operators import counts
from ratewatch.schemas import ANOMALY_TABLE, COUNT_TABLE, MEAN_TABLE, RESULT_KEY, TICK_KEY, TICK_TABLE
from ratewatch.sources import lines, messages, tables
from ratewatch.streaming import jobs, sinks
from ratewatch.streaming.runner import Run, late_rows, rows_without_time, start

BASE = 1_530_000_000_000


def record(second, marker="X", points="1"):
    fields = {"fx_marker": marker, "timestamp_ms": str(BASE + int(second * 1000)), "bid_points": points}
    return json.dumps({**dict.fromkeys(("bid_big", "offer_big", "offer_points", "hight", "low", "open"), "1"), **fields})


# Unfinished window, its completion, two moves of the watermark, a late tick, closing.
FILES = [(0, 1), (2, 3, 4), (200,), (210,), (5, 215), (500,)]


class Stream:
    """A topic to which messages are added; after each, the stream runs and stops."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.offset = spark, str(folder), 0
        self.late = self.timeless = 0

    def send(self, start, *values, **settings):
        for value in values:
            row = self.spark.createDataFrame([(None, value.encode(), self.offset)], "key string, value binary, offset bigint")
            messages.append_topic(row, f"{self.folder}/topic")
            self.offset += 1
            self.run(start, **settings)

    def run(self, start, **settings):
        topic = messages.read_topic(self.spark, f"{self.folder}/topic", stream=True)
        run = Run(f"{self.folder}/checkpoint", once=True, state_partitions=2, **{"rocksdb": False, **settings})
        query = start(topic, f"{self.folder}/table", run)
        query.awaitTermination()
        self.late += late_rows(query)
        self.timeless += rows_without_time(query)

    def table(self, schema, keys=RESULT_KEY):
        return tables.read_latest(self.spark, f"{self.folder}/table", schema, keys)


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


@pytest.fixture
def limits(spark):
    return spark.createDataFrame([("X", 4.0, 6.0)], "fx_marker string, stream_stat_min double, stream_stat_max double")


def frames(files=FILES):
    return ["\n".join(record(second) for second in file) for file in files]


def alarms(table):
    second = (F.unix_millis("window_start") - BASE) / 1000
    rows = table.where("is_anomaly").select(second.alias("s"), "anomaly_count").collect()
    return sorted((r["s"], r["anomaly_count"]) for r in rows)


def test_unfinished_window(stream, limits):
    """Append mode judges complete windows only: [0, 10) ends with 5 ticks and is no anomaly."""
    stream.send(lambda t, path, run: jobs.run_anomalies(t, limits, path, run), *frames(), mode="append")
    assert alarms(stream.table(ANOMALY_TABLE)) == [(200.0, 1.0), (210.0, 2.0)]


def test_late_rows(stream, limits):
    stream.send(lambda t, path, run: jobs.run_anomalies(t, limits, path, run), *frames(), mode="append")
    assert stream.late == 1


def test_ticks_without_a_time_are_counted(stream):
    values = "\n".join([record(0), record(10**13), record(1).replace(str(BASE + 1000), "soon")])
    stream.send(lambda t, path, run: jobs.run_counts(t, path, run), values, record(2))
    assert stream.timeless == 2


def test_update_mode_takes_an_early_alarm_back(stream, limits):
    def start(t, path, run):
        return jobs.run_anomalies(t, limits, path, run)

    stream.send(start, frames()[0])
    assert alarms(stream.table(ANOMALY_TABLE)) == [(0.0, 2.0)]
    stream.send(start, *frames()[1:])
    assert alarms(stream.table(ANOMALY_TABLE)) == [(200.0, 1.0), (210.0, 2.0), (500.0, 1.0)]


def test_restart_is_idempotent(stream):
    def start(t, path, run):
        return jobs.run_means(t, path, run)

    stream.send(start, *frames([(0, 1), (2,)]))
    once = sorted(map(tuple, stream.table(MEAN_TABLE).collect()))
    stream.run(start)
    assert sorted(map(tuple, stream.table(MEAN_TABLE).collect())) == once
    stream.send(start, *frames([(3,)]))
    assert stream.table(MEAN_TABLE).count() == len(once)


def test_state_in_rocksdb_gives_the_same(stream, limits):
    stream.send(lambda t, path, run: jobs.run_anomalies(t, limits, path, run), *frames(), mode="append", rocksdb=True)
    assert alarms(stream.table(ANOMALY_TABLE)) == [(200.0, 1.0), (210.0, 2.0)]


def test_repeated_ticks_can_count_once(stream, spark):
    low = spark.createDataFrame([("X", 2.0, 9.0)], "fx_marker string, stream_stat_min double, stream_stat_max double")
    values = frames([(0, 0, 0), (200,), (300,)])
    stream.send(lambda t, path, run: jobs.run_anomalies(t, low, path, run, dedup=True), *values, mode="append")
    assert (0.0, 1.0) in alarms(stream.table(ANOMALY_TABLE))


def test_listed_markers_only(stream):
    frame = "\n".join([record(0), record(0, "Y"), record(0, ""), "", "junk"])
    stream.send(lambda t, path, run: jobs.run_counts(t, path, run, markers=["Y"]), frame)
    rows = stream.spark.read.parquet(f"{stream.folder}/table")
    assert [(r["fx_marker"], r["count"]) for r in rows.collect()] == [("Y", 1)]


def gather(spark, path, mean, at):
    row = spark.createDataFrame([("X", mean, 0.0)], "fx_marker string, avg_count double, stddev_count double")
    tables.append_statistics(row.withColumn("stat_gathered_date", F.lit(at).cast("timestamp")), path)


def bounds_at(path):
    return lambda spark: counts.bounds(tables.newest_statistics(spark, path))


def test_a_running_stream_uses_new_statistics(stream, spark):
    stats, topic = f"{stream.folder}/statistics", f"{stream.folder}/topic"

    def add(second):
        messages.append_topic(spark.createDataFrame([(None, record(second).encode(), 0)], "key string, value binary, offset bigint"), topic)

    gather(spark, stats, 1.0, "2024-01-01 00:00:00")
    add(0)
    run = Run(f"{stream.folder}/checkpoint", state_partitions=2)
    source = messages.read_topic(spark, topic, stream=True)
    query = jobs.run_anomalies(source, bounds_at(stats), f"{stream.folder}/table", run)
    query.processAllAvailable()
    assert alarms(stream.table(ANOMALY_TABLE)) == []
    gather(spark, stats, 2.0, "2024-01-02 00:00:00")
    add(20)
    query.processAllAvailable()
    query.stop()
    assert alarms(stream.table(ANOMALY_TABLE)) == [(20.0, 1.0)]


@pytest.mark.parametrize("mode", ["append", "update"])
@pytest.mark.parametrize("given", ["stored", "asked", "local"])
def test_state_is_kept_while_there_are_no_statistics(stream, spark, mode, given):
    path = f"{stream.folder}/statistics"
    limits = {
        "stored": bounds_at(path)(spark),
        "asked": bounds_at(path),
        "local": spark.createDataFrame([], "fx_marker string, stream_stat_min double, stream_stat_max double"),
    }[given]

    def start(t, table, run):
        return jobs.run_anomalies(t, limits, table, run)

    stream.send(start, *frames([(0, 1), (2,)]), mode=mode)
    assert stream.table(ANOMALY_TABLE).count() == 0
    if given == "asked":
        row = spark.createDataFrame([("X", 9.0, 0.0)], "fx_marker string, avg_count double, stddev_count double")
        tables.append_statistics(row.withColumn("stat_gathered_date", F.current_timestamp()), path)
        stream.send(start, *frames([(3,), (200,), (400,)]), mode=mode)
        assert alarms(stream.table(ANOMALY_TABLE))[0] == (0.0, 4.0)


def test_stored_ticks_quarantine_and_view(stream, spark):
    view, bad = f"{stream.folder}/view", f"{stream.folder}/bad"

    def start(t, path, run):
        return jobs.run_store_ticks(t, path, bad, run, view, n=2)

    def seen():
        rows = sinks.read_view(spark, view, TICK_TABLE).orderBy("fx_marker", F.desc("timestamp_ms"))
        return [(r["fx_marker"], (r["timestamp_ms"] - BASE) // 1000, r["bid_points"]) for r in rows.collect()]

    stream.send(start, "\n".join([record(1, points="1"), record(1, points="2"), record(0), record(2, points="x"), "", "junk", record(3, "Y")]), mode="append")
    assert seen() == [("X", 1, 2), ("X", 0, 1), ("Y", 3, 1)]
    stream.send(start, "\n".join([record(1, points="7"), record(9), record(-5)]), mode="append")
    assert seen() == [("X", 9, 1), ("X", 1, 7), ("Y", 3, 1)]
    for second in range(10, 16):
        stream.send(start, record(second), mode="append")
    assert seen() == [("X", 15, 1), ("X", 14, 1), ("Y", 3, 1)]
    now = stream.table(TICK_TABLE, TICK_KEY)
    assert now.count() == 11 and now.where(f"timestamp_ms = {BASE + 1000}").first()["bid_points"] == 7
    rejected = spark.read.parquet(bad).orderBy("record").collect()
    assert [r["bad_fields"].split(",")[0] for r in rejected] == ["fx_marker", "bid_points"]
    assert rejected[0]["record"] == "junk"


def test_views_of_means_and_anomalies(stream, spark, limits, tmp_path):
    means, found = f"{tmp_path}/means", f"{tmp_path}/found"
    stream.send(lambda t, path, run: jobs.run_means(t, path, run, means, 2, duration=10, slide=10), *frames([(0,), (10, 20), (21,)]))
    rows = sinks.read_view(spark, means, MEAN_TABLE).orderBy("window_start").collect()
    assert [r["window_start"].timestamp() * 1000 - BASE for r in rows] == [10_000, 20_000]
    other = Stream(spark, tmp_path / "other")
    other.send(lambda t, path, run: jobs.run_anomalies(t, limits, path, run, found), *frames(), mode="append")
    assert alarms(sinks.read_view(spark, found, ANOMALY_TABLE)) == [(200.0, 1.0), (210.0, 2.0)]


def test_a_view_refreshed_twice_by_one_batch_stays_the_same(spark, tmp_path):
    schema = MEAN_TABLE
    sinks.create_view(spark, f"{tmp_path}/v", schema)
    write = sinks.serve(f"{tmp_path}/v", schema, 2, "window_start")

    def means(*seconds):
        rows = [("X", s, float(s)) for s in seconds]
        df = spark.createDataFrame(rows, "fx_marker string, s bigint, bid_big_avg double")
        start = F.timestamp_seconds("s")
        return df.select("fx_marker", F.to_date(start).alias("timestamp_d"), start.alias("window_start"), start.alias("window_end"), "bid_big_avg", F.lit(0.0).alias("bid_points_avg"))

    for batch, seconds in ((0, (1, 2, 3)), (1, (5,)), (1, (5,)), (6, (4,)), (6, (4,))):
        write(means(*seconds), batch)
    rows = sinks.read_view(spark, f"{tmp_path}/v", schema).collect()
    assert sorted(r["bid_big_avg"] for r in rows) == [4.0, 5.0]


def test_responses_to_topic_to_results_to_table(stream, spark, tmp_path):
    """Publish, compute, publish results and store them, each as a stream of its own."""
    polls = tmp_path / "polls"
    polls.mkdir()
    quote = "X,{},1,{},1,1,1,1,1"
    (polls / "a.csv").write_text("\n".join([quote.format(BASE, 1), "bad,line", quote.format(BASE + 1000, 3)]))
    (polls / "b.csv").write_text("nothing useful\n")
    raw, results = f"{stream.folder}/raw", f"{stream.folder}/results"

    def run(name, mode="append"):
        return Run(f"{stream.folder}/{name}", mode, once=True, state_partitions=2)

    responses = lines.quote_responses(spark, str(polls), stream=True)
    jobs.run_publish(responses, raw, run("p"), 4).awaitTermination()
    jobs.run_quarantine(responses, f"{raw}-bad", run("q")).awaitTermination()
    assert {r["value"] for r in spark.read.parquet(f"{raw}-bad").collect()} == {"bad,line", "nothing useful"}
    assert messages.read_topic(spark, raw).count() == 1
    topic = messages.read_topic(spark, raw, stream=True)
    jobs.run_publish_results(jobs.mean_messages(topic), results, run("m", "update")).awaitTermination()
    found = messages.read_topic(spark, results, stream=True)
    jobs.run_store_results(found, f"{stream.folder}/table", run("s"), "means").awaitTermination()
    rows = stream.table(MEAN_TABLE)
    assert rows.count() == 6
    assert {r["bid_points_avg"] for r in rows.collect()} == {2.0}


def test_a_batch_published_again_does_not_stop_its_readers(stream, spark):
    topic = f"{stream.folder}/topic"
    batch = spark.createDataFrame([("X", "\n".join(map(record, (0, 1))))], "key string, value string")
    publish = sinks.publish(topic)
    publish(batch, 0)

    def fails(t, path, run):
        def write(rows, batch_id):
            raise RuntimeError("lost")

        return start(jobs.window_counts(t), write, run)

    with pytest.raises(StreamingQueryException):
        stream.run(fails)
    publish(batch, 0)
    stream.run(lambda t, path, run: jobs.run_counts(t, path, run))
    stream.run(lambda t, path, run: jobs.run_counts(t, path, run))
    rows = spark.read.parquet(f"{stream.folder}/table").collect()
    assert [(r["fx_marker"], r["count"]) for r in rows] == [("X", 2)]


def test_a_raw_batch_published_again_counts_once(stream, spark, tmp_path):
    """The commit of a batch is lost after its reader has taken it; the batch runs again."""
    polls, raw, checkpoint = tmp_path / "polls", f"{tmp_path}/topic", f"{tmp_path}/publisher"
    polls.mkdir()
    (polls / "a.csv").write_text("\n".join(f"X,{BASE + ms},1,1,1,1,1,1,1" for ms in (0, 1000)))

    def publish():
        responses = lines.quote_responses(spark, str(polls), stream=True)
        jobs.run_publish(responses, raw, Run(checkpoint, "append", once=True)).awaitTermination()

    publish()
    stream.run(lambda t, path, run: jobs.run_counts(t, path, run))
    for name in ("0", ".0.crc"):
        (tmp_path / "publisher/commits" / name).unlink()
    publish()
    stream.run(lambda t, path, run: jobs.run_counts(t, path, run))
    rows = spark.read.parquet(f"{stream.folder}/table").collect()
    assert [(r["fx_marker"], r["count"]) for r in rows] == [("X", 2)]


def test_the_later_poll_wins_whatever_its_line(stream, spark):
    def poll(time, *points):
        value = "\n".join(record(k, points=p) for k, p in points)
        row = spark.createDataFrame([(None, value.encode(), time)], "key string, value binary, time bigint")
        return row.withColumn("time", F.timestamp_seconds("time"))

    both = poll(100, (5, "1"), (0, "9"), (1, "1")).unionAll(poll(200, (0, "7")))
    messages.append_topic(both, f"{stream.folder}/topic")
    stream.run(lambda t, path, run: jobs.run_store_ticks(t, path, f"{stream.folder}/bad", run), mode="append")
    now = stream.table(TICK_TABLE, TICK_KEY).where(f"timestamp_ms = {BASE}").collect()
    assert [r["bid_points"] for r in now] == [7]


def test_the_last_of_several_versions_in_one_batch_is_stored(stream, spark):
    value = '{{"window":{{"start":"2018-06-26T08:00:00.000Z","end":"2018-06-26T08:00:30.000Z"}},"fx_marker":"X","avg(bid_big)":{0},"avg(bid_points)":{0}}}'
    rows = [("X", value.format(i % 50).encode(), i) for i in range(100)]
    messages.append_topic(spark.createDataFrame(rows, "key string, value binary, offset bigint").repartition(5), f"{stream.folder}/topic")
    stream.run(lambda t, path, run: jobs.run_store_results(t, path, run, "means"), mode="append")
    row = stream.table(MEAN_TABLE).first()
    assert (row["bid_big_avg"], row["bid_points_avg"]) == (49.0, 49.0)


def test_every_trigger_can_be_asked_for(stream, spark):
    messages.append_topic(spark.createDataFrame([(None, record(0).encode(), 0)], "key string, value binary, offset bigint"), f"{stream.folder}/topic")
    topic = messages.read_topic(spark, f"{stream.folder}/topic", stream=True)
    run = Run(f"{stream.folder}/c", every="1 second", state_partitions=2, name="refresh")
    query = jobs.run_counts(topic, f"{stream.folder}/table", run)
    query.processAllAvailable()
    assert query.name == "refresh" and query.isActive
    query.stop()
    assert spark.read.parquet(f"{stream.folder}/table").count() == 1


def test_a_backlog_in_bounded_batches(spark, tmp_path):
    for second in range(6):
        row = spark.createDataFrame([(None, record(second).encode(), second)], "key string, value binary, offset bigint")
        messages.append_topic(row.coalesce(1), f"{tmp_path}/topic")
    topic = messages.read_topic(spark, f"{tmp_path}/topic", stream=True, most=2)
    query = jobs.run_counts(topic, f"{tmp_path}/table", Run(f"{tmp_path}/c", once=True, state_partitions=2, rocksdb=False))
    query.awaitTermination()
    read = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(read) >= 3 and sum(read) == 6
    assert tables.read_latest(spark, f"{tmp_path}/table", COUNT_TABLE, RESULT_KEY).first()["count"] == 6


def test_messages_since_a_time(spark, tmp_path):
    rows = spark.sql("select null as key, binary('x') as value, id as offset, timestamp_seconds(id) as time from range(5)")
    messages.append_topic(rows, f"{tmp_path}/topic")
    since = datetime.fromtimestamp(3, timezone.utc)
    assert messages.read_topic(spark, f"{tmp_path}/topic", since=since).count() == 2


@pytest.mark.parametrize("offset, pos", [(10**13 - 1, 0), (-1, 0), (0, 10**9 - 1)])
def test_a_place_that_does_not_fit_is_an_error(spark, offset, pos):
    rows = spark.createDataFrame([(offset, pos)], "offset bigint, pos int")
    with pytest.raises(Exception, match="does not fit"):
        rows.select(sinks._place(("offset", "pos"))).collect()


def test_places_order_as_their_parts(spark):
    places = [(t, o, p) for t in (None, 0, 10**16 - 2) for o in (None, 0, 10**13 - 2) for p in (0, 10**9 - 2)]
    rows = spark.createDataFrame([(n, *p) for n, p in enumerate(places)], "n int, t bigint, offset bigint, pos int")
    rows = rows.withColumn("time", F.timestamp_micros("t")).withColumn("place", sinks._place(("time", "offset", "pos")))
    assert [r["n"] for r in rows.orderBy("place").collect()] == list(range(len(places)))
    assert rows.select("place").distinct().count() == len(places)
