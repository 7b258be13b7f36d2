"""The commands, from captured responses to stored anomalies."""

import pytest

from ratewatch import cli
from ratewatch.schemas import ANOMALY_TABLE, MEAN_TABLE, RESULT_KEY, TICK_KEY, TICK_TABLE
from ratewatch.sources import tables

BASE = 1_530_000_000_000


def test_the_whole_pipeline(spark, tmp_path):
    polls = tmp_path / "polls"
    polls.mkdir()
    times = [BASE + ms for ms in (0, 1000, 10_000, 20_000, 30_000, 30_001, 30_002, 30_003, 300_000)]
    quotes = [f"{m},{ms},1,2,1,2,1,1,1" for ms in times for m in ("USD/JPY", "EUR/USD")]
    (polls / "poll.csv").write_text("\n".join(quotes))

    def run(command, **options):
        argv = [command]
        if command not in ("gather-statistics", "compact"):
            argv += ["--once", "--checkpoint", f"{tmp_path}/c-{command}", "--state-partitions", "2"]
        for key, value in options.items():
            argv += [value] if key == "dates" else [f"--{key.replace('_', '-')}", f"{tmp_path}/{value}" if key not in ("marker", "kind", "k", "duration") else value]
        cli.main(argv, spark)

    run("publish", responses="polls", topic="raw")
    run("store-ticks", topic="raw", table="ticks", quarantine="bad", view="view")
    run("gather-statistics", dates="2018-06-26 2018-06-27", history="ticks", statistics="stats", marker="USD/JPY")
    run("gather-statistics", dates="2018-06-26", history="ticks", statistics="all")
    run("sliding-mean", topic="raw", table="means")
    run("count-anomalies", topic="raw", statistics="stats", out_topic="alarms", k="1")
    run("store-results", topic="alarms", table="anomalies", kind="anomalies")
    run("compact", kind="ticks", table="ticks", target="packed")
    run("gather-statistics", dates="2018-06-26", history="ticks", compacted="packed", statistics="again")

    stats = tables.statistics_history(spark, f"{tmp_path}/stats").collect()
    assert [(r["fx_marker"], r["avg_count"]) for r in stats] == [("USD/JPY", 1.8)]
    for name in ("all", "again"):
        assert sorted(r["avg_count"] for r in tables.newest_statistics(spark, f"{tmp_path}/{name}").collect()) == [1.8, 1.8]
    assert tables.read_latest(spark, f"{tmp_path}/means", MEAN_TABLE, RESULT_KEY).count() > 0
    found = tables.read_latest(spark, f"{tmp_path}/anomalies", ANOMALY_TABLE, RESULT_KEY).collect()
    assert [(r["fx_marker"], r["anomaly_count"]) for r in found] == [("USD/JPY", 4.0)]
    packed = tables.read_latest(spark, f"{tmp_path}/ticks", TICK_TABLE, TICK_KEY, compacted=f"{tmp_path}/packed")
    assert packed.count() == 18


def test_kafka_refuses_what_it_cannot_do(spark, tmp_path):
    argv = ["publish", "--topic", "t", "--checkpoint", "c", "--format", "kafka", "--responses", str(tmp_path)]
    with pytest.raises(SystemExit):
        cli.main([*argv, "--quarantine", "q"], spark)


def test_one_target_is_required():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["sliding-mean", "--topic", "t", "--checkpoint", "c"])
