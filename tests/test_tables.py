"""Table layout, versions and compaction."""

import glob

import pytest
from pyspark.sql import functions as F

from ratewatch import session
from ratewatch.operators import counts, ticks
from ratewatch.operators.latest import latest
from ratewatch.operators.serving import of_marker
from ratewatch.schemas import TICK_KEY, TICK_TABLE
from ratewatch.sources import messages, tables


@pytest.fixture
def stored_ticks(spark, make_ticks):
    def make(*rows):
        full = ticks.with_date(make_ticks(*rows))
        return full.select(
            *[F.col(f.name) if f.name in full.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TICK_TABLE]
        )

    return make


def test_files_are_by_marker_and_date_and_newest_first(spark, stored_ticks, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(stored_ticks(("123", 5, 1.0, 1), ("E/U", 1, 1.0, 1), ("E/U", 9, 1.0, 2), ("E/U", 4, 1.0, 3)), path)
    assert len(glob.glob(f"{path}/fx_marker=E%2FU/timestamp_d=2018-06-26/*.parquet")) == 1
    read = tables.read_table(spark, path, TICK_TABLE)
    assert [r["bid_points"] for r in read.where("fx_marker = 'E/U'").collect()] == [2, 3, 1]
    assert read.where("fx_marker = '123'").count() == 1


def test_a_rerun_batch_replaces_itself_and_later_batches_win(spark, stored_ticks, tmp_path):
    path = str(tmp_path / "t")
    tables.write_version(stored_ticks(("A", 1, 1.0, 1), ("A", 2, 1.0, 1), ("B", 1, 1.0, 1)), path, 0)
    tables.write_version(stored_ticks(("A", 1, 2.0, 2)), path, 1)
    tables.write_version(stored_ticks(("A", 1, 3.0, 3)), path, 1)
    got = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY).orderBy("fx_marker", "timestamp_ms")
    assert [r["bid_points"] for r in got.collect()] == [3, 1, 1]
    one = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, "A", ["2018-06-26"], record_id=True)
    assert one.count() == 2 and len(one.first()["record_id"]) == 64
    assert tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, "A", ["2018-06-27"]).count() == 0


def test_compaction_changes_no_row(spark, stored_ticks, tmp_path):
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")
    for batch in range(3):
        tables.write_version(stored_ticks(("A", 1, 1.0, batch), ("A", 10 + batch, 1.0, batch)), path, batch)
    tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY, upto=1)
    before = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY).orderBy(*TICK_KEY).collect()
    both = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, compacted=packed)
    assert both.select(*TICK_KEY).count() == 4
    assert both.orderBy(*TICK_KEY).collect() == before
    assert spark.read.parquet(f"{packed}/data").count() == 3


def test_compactions_go_on_and_are_never_half_seen(spark, stored_ticks, tmp_path):
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")

    def now():
        rows = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, compacted=packed)
        return [tuple(r) for r in rows.orderBy(*TICK_KEY).collect()]

    reader = None
    for batch in range(4):
        tables.write_version(stored_ticks(("A", 1, 1.0, batch), ("A", 10 + batch, 1.0, batch)), path, batch)
        whole = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY).orderBy(*TICK_KEY)
        whole = [tuple(r) for r in whole.collect()]
        assert now() == whole
        reader = reader or tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, compacted=packed)
        tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY)
        assert now() == whole
    assert tables.compactions(spark, packed) == [(3, 2, 3), (2, 1, 2), (1, 0, 1), (0, -1, 0)]
    assert spark.read.parquet(f"{packed}/data/run=3").count() == 2
    # One that was lost half way has no pointer and is not read.
    stored_ticks(("A", 99, 1.0, 9)).withColumn("batch_id", F.lit(9).cast("long")).write.partitionBy(
        "fx_marker", "timestamp_d"
    ).parquet(f"{packed}/data/run=4")
    assert now() == whole
    tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY, full=True)
    assert tables.compactions(spark, packed) == [(4, -1, 3)] and now() == whole
    tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY)
    assert tables.compactions(spark, packed) == [(4, -1, 3)]
    assert reader.count() == 2


def test_the_compacted_copy_prunes_markers_and_dates(spark, stored_ticks, tmp_path):
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")
    tables.write_version(stored_ticks(("A", 1, 1.0, 1), ("B", 1, 1.0, 1)), path, 0)
    tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY)
    rows = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, "A", ["2018-06-26"], compacted=packed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert any("fx_marker" in p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]) and rows.count() == 1


def test_a_null_order_loses_and_keeps_its_row(spark):
    rows = spark.createDataFrame(
        [("A", None, 1), ("A", 3, 2), ("A", -5, 3), ("B", None, 4)], "k string, at bigint, v int"
    )
    got = {r["k"]: (r["v"], r["at"]) for r in latest(rows, ("k",), "at").collect()}
    assert got == {"A": (2, 3), "B": (4, None)}


def test_a_file_holds_no_more_rows_than_told(spark, stored_ticks, tmp_path):
    tables.write_table(stored_ticks(*[("A", i, 1.0, i) for i in range(100)]), str(tmp_path / "t"), file_rows=30)
    assert len(glob.glob(f"{tmp_path}/t/*/*/*.parquet")) == 4


def test_statistics_are_appended_and_the_last_are_read(spark, tmp_path):
    path = str(tmp_path / "s")
    for at, mean in (("2024-01-02 00:00:00", 2.0), ("2024-01-03 00:00:00", 3.0), ("2024-01-01 00:00:00", 1.0)):
        row = spark.createDataFrame([("A", mean, 0.5)], "fx_marker string, avg_count double, stddev_count double")
        tables.append_statistics(row.withColumn("stat_gathered_date", F.lit(at).cast("timestamp")), path)
    stats = tables.statistics_history(spark, path)
    assert stats.count() == 3
    assert counts.latest_statistics(stats).first()["avg_count"] == 3.0
    assert [r["avg_count"] for r in tables.newest_statistics(spark, path).collect()] == [3.0]


def test_a_run_of_statistics_adds_few_files(spark, tmp_path):
    path = str(tmp_path / "s")
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = spark.range(500).select(F.concat(F.lit("m"), "id").alias("fx_marker"), at.alias("stat_gathered_date"))
    rows = rows.withColumn("avg_count", F.lit(1.0)).withColumn("stddev_count", F.lit(0.0))
    for run in range(2):
        tables.append_statistics(rows, path)
        assert len(glob.glob(f"{path}/history/*/*.parquet")) <= 4 * (run + 1)
    assert tables.newest_statistics(spark, path).count() == 500


def test_markers_and_dates_prune_partitions(spark, stored_ticks, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(stored_ticks(("A", 1, 1.0, 1), ("B", 1, 1.0, 1)), path)
    read = of_marker(tables.read_table(spark, path, TICK_TABLE), "A", ["2018-06-26", "2018-06-27"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "fx_marker" in pruned and "timestamp_d" in pruned and "cast" not in pruned


def test_results_of_a_marker_share_a_topic_partition(spark, tmp_path):
    rows = spark.range(300).selectExpr("concat('m', id % 7) as key", "'x' as value", "id as offset")
    spread = messages.spread(rows, 3, "key").withColumn("p", F.spark_partition_id())
    assert spread.groupBy("key").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    assert messages.spread(rows, 36).rdd.getNumPartitions() == 36
    messages.append_topic(rows, str(tmp_path / "topic"), partitions=3, key="key")
    assert messages.read_topic(spark, str(tmp_path / "topic")).count() == 300


def test_the_cluster_names_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    one, other = session.run_folder(spark, "x"), session.run_folder(spark, "x")
    assert one != other and one.startswith(f"{named}/ratewatch/x-")


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.settings(spark, {"spark.sql.shuffle.partitions": "17"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "17"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def folders(path):
    return sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{path}/*=*"))


def test_pruned_tables_read_the_same(spark, stored_ticks, tmp_path):
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")

    def read():
        rows = tables.read_latest(spark, path, TICK_TABLE, TICK_KEY, compacted=packed).orderBy(*TICK_KEY)
        return rows.select(*TICK_KEY, "bid_points", "batch_id").collect()

    for batch in range(4):
        tables.write_version(stored_ticks(("A", 1, 1.0, batch), ("B", 10 + batch, 1.0, batch)), path, batch)
        if batch in (1, 2):
            tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY)
    before = read()
    tables.prune(spark, path, packed)
    assert len(folders(path)) == 4
    tables.prune(spark, path, packed, keep=-1)
    assert folders(path) == ["batch_id=3"] and read() == before
    tables.compact(spark, path, packed, TICK_TABLE, TICK_KEY, full=True)
    tables.prune(spark, path, packed, keep=-1)
    assert folders(path) == []
    assert folders(f"{packed}/data") == ["run=2"] and folders(f"{packed}/pointers") == ["at=2"] and read() == before
    # A batch that the stream runs again after that is not read twice.
    tables.write_version(stored_ticks(("A", 1, 1.0, 3), ("B", 13, 1.0, 3)), path, 3)
    assert read() == before


def test_a_marker_that_is_not_there_opens_no_row_group(spark, stored_ticks, tmp_path):
    path = str(tmp_path / "t")
    rows = stored_ticks(*[(m, i, 1.0, i) for m in "ACE" for i in range(200)]).coalesce(1)
    tables.write_version(rows, path, 0, ("fx_marker", "timestamp_ms"))
    for marker, read in (("A", True), ("B", False), ("D", False)):
        found = spark.read.schema(TICK_TABLE).parquet(path).where(F.col("fx_marker") == marker)
        assert (found.count() > 0) == read
        plan = found._jdf.queryExecution().executedPlan()
        found.collect()
        scan = plan.collectLeaves().head()
        assert (scan.metrics().apply("numOutputRows").value() > 0) == read


def test_newest_rows_read_few_dates(spark, stored_ticks, tmp_path):
    path = str(tmp_path / "t")
    day = 86_400_000
    tables.write_table(stored_ticks(*[("A", d * day + i, 1.0, i) for d in range(6) for i in range(5)], ("B", 9 * day, 1.0, 1)), path)
    rows = of_marker(tables.read_table(spark, path, TICK_TABLE), "A", dates := [f"2018-06-{26 + d}" for d in range(5)])
    assert tables.newest_dates(rows, dates, 5) == dates[:3:-1]
    assert tables.newest_dates(rows, dates, 6) == dates[:2:-1]
    assert tables.newest_dates(rows, dates, 11) == dates[:0:-1]
    assert tables.newest_dates(rows, dates, 99) == dates[::-1]


def test_statistics_gathered_again_leave_no_old_folders(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    stats = spark.sql("select 'A' as fx_marker, timestamp'2018-07-05 08:00:00' as stat_gathered_date, 1d as avg_count, 0d as stddev_count")
    monkeypatch.setattr(tables, "KEEP_SECONDS", -1)
    for _ in range(3):
        tables.append_statistics(stats, path)
    assert folders(f"{path}/newest") == ["run=2"] and tables.newest_statistics(spark, path).count() == 1
