"""Statistics merged from sums by day."""

import random

import pytest
from pyspark.sql import functions as F

from ratewatch.operators import counts, daily
from ratewatch.schemas import DAY_KEY, DAY_TABLE
from ratewatch.sources import tables
from ratewatch.streaming import jobs
from test_streams import Stream, record

DAY = 86_400_000
DATES = ["2018-06-26", "2018-06-27", "2018-06-28", "2018-06-29"]


@pytest.fixture
def ticks(make_ticks):
    rng = random.Random(3)
    rows = [(rng.choice("AAB"), rng.randrange(0, 3 * DAY), 1.0, 1) for _ in range(400)]
    return make_ticks(*rows, ("C", 5, 1.0, 1)).withColumn("timestamp_d", F.to_date("ts"))


def plain(stats):
    return sorted(
        (r["fx_marker"], round(r["avg_count"], 9), None if r["stddev_count"] is None else round(r["stddev_count"], 9))
        for r in stats.collect()
    )


@pytest.mark.parametrize("dates", [DATES, DATES[:1], DATES[1:3], [DATES[0], DATES[2]], ["2017-01-01"]])
def test_merged_is_plain_over_any_dates(ticks, dates):
    sums = daily.day_sums(counts.tumbling_count(ticks, 600))
    assert plain(daily.merged_statistics(sums, dates)) == plain(counts.all_statistics(ticks, dates, 600))


def test_large_counts_keep_their_deviation(spark):
    rows = [("A", "2018-06-26", 2, 2 * 10**15 + 1, str(10**30 + (10**15 + 1) ** 2))]
    sums = spark.createDataFrame(rows, "fx_marker string, day string, n bigint, total bigint, squares string")
    sums = sums.withColumn("squares", F.col("squares").cast("decimal(38,0)")).withColumn("day", F.to_date("day"))
    assert abs(daily.merged_statistics(sums).first()["stddev_count"] - 0.5**0.5) < 1e-9


def test_a_day_gathered_again_replaces_itself_and_dates_prune_the_table(spark, ticks, tmp_path):
    path = str(tmp_path / "days")
    tables.write_days(daily.day_sums(counts.tumbling_count(ticks, 600)), path)
    late = ticks.where(F.col("timestamp_d") == DATES[1]).limit(3)
    tables.write_days(daily.day_sums(counts.tumbling_count(late, 600)), path)
    table = tables.read_table(spark, path, DAY_TABLE)
    some = daily.merged_statistics(table, DATES[:2])
    both = ticks.where(F.col("timestamp_d") != DATES[1]).unionByName(late)
    text = some._jdf.queryExecution().executedPlan().toString()
    assert plain(some) == plain(counts.all_statistics(both, DATES[:2], 600))
    assert "PartitionFilters: [day" in text and text.count("FileScan") == 1


def test_stream_of_counts_to_sums_by_day(spark, tmp_path, make_ticks):
    stream = Stream(spark, tmp_path)
    days = [[(0, "A"), (5, "A"), (15, "B")], [(40, "A")], [(86_400, "A"), (86_500, "B")], [(3 * 86_400, "A")], [(9 * 86_400, "A")]]
    texts = ["\n".join(record(s, m) for s, m in file) for file in days]
    stream.send(lambda t, path, run: jobs.run_day_sums(t, path, run), *texts, mode="append")
    found = tables.read_latest(spark, f"{stream.folder}/table", DAY_TABLE, DAY_KEY)
    values = [(m, int(s * 1000), 1.0, 1) for file in days[:-1] for s, m in file]
    wanted = daily.day_sums(counts.tumbling_count(make_ticks(*values)))
    assert sorted(map(tuple, found.select(*DAY_TABLE.names).collect())) == sorted(map(tuple, wanted.select(*DAY_TABLE.names).collect()))
