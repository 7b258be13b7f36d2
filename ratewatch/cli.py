"""The jobs as commands.

    spark-submit --py-files ratewatch.zip run_job.py sliding-mean --topic ... --table ...

A topic is a folder, or with ``--format kafka`` the name of a Kafka topic; options of
the connector are given as ``--option key=value``.
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import datetime

from pyspark.sql import SparkSession

from ratewatch.operators import counts, daily, envelope
from ratewatch.schemas import ANOMALY_TABLE, DAY_KEY, DAY_TABLE, MEAN_TABLE, RESULT_KEY, TICK_KEY, TICK_TABLE
from ratewatch.session import configure
from ratewatch.sources import lines, messages, tables
from ratewatch.streaming import corrections, jobs, sinks
from ratewatch.streaming.runner import Run, start, start_kafka

TABLES = {
    "ticks": (TICK_TABLE, TICK_KEY),
    "means": (MEAN_TABLE, RESULT_KEY),
    "anomalies": (ANOMALY_TABLE, RESULT_KEY),
}


def _pairs(options: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def _run(args: argparse.Namespace, mode: str) -> Run:
    return Run(args.checkpoint, args.mode or mode, args.every, args.once, args.state_partitions)


def _topic(spark: SparkSession, args: argparse.Namespace):
    since = datetime.fromisoformat(args.since) if args.since else None
    options = {"since": since, "most": args.most, "most_bytes": args.most_bytes, **_pairs(args.option)}
    return messages.read_topic(spark, args.topic, args.format, stream=True, **options)


def _kafka(args: argparse.Namespace) -> str:
    return _pairs(args.option)["kafka.bootstrap.servers"]


def publish(spark: SparkSession, args: argparse.Namespace):
    responses = lines.quote_responses(spark, args.responses, stream=True)
    if args.format == "kafka":
        if args.quarantine or args.partitions:
            raise SystemExit("--quarantine and --partitions are for topics in folders")
        framed = jobs.response_messages(responses)
        return start_kafka(framed, args.topic, _kafka(args), _run(args, "append"))
    run = _run(args, "append")
    if args.quarantine:
        aside = replace(run, checkpoint=f"{args.checkpoint}-quarantine")
        rejected = jobs.run_quarantine(responses, args.quarantine, aside)
        if args.once:
            rejected.awaitTermination()
    return jobs.run_publish(responses, args.topic, run, args.partitions)


def _writer(args: argparse.Namespace, decode) -> sinks.Writer:
    if args.out_topic is None:
        return sinks.upsert(args.table, decode)
    if args.format == "kafka":
        return sinks.send(args.out_topic, "kafka", **_pairs(args.option))
    return sinks.publish(args.out_topic, args.out_partitions, "key")


def sliding_mean(spark: SparkSession, args: argparse.Namespace):
    means = jobs.mean_messages(_topic(spark, args), args.duration, args.slide, args.watermark)
    return start(means, _writer(args, envelope.decode_means), _run(args, "update"))


def count_anomalies(spark: SparkSession, args: argparse.Namespace):
    def limits(session: SparkSession):
        return counts.bounds(tables.newest_statistics(session, args.statistics), args.k)

    return jobs.run_judged(
        _topic(spark, args), limits, _writer(args, envelope.decode_anomalies), _run(args, "append"),
        markers=args.marker, duration=args.duration, watermark=args.watermark,
        dedup=not args.repeats, silent=args.silent,
    )


def sum_days(spark: SparkSession, args: argparse.Namespace):
    """Sums of counts by day, from which statistics of any dates are merged."""
    return jobs.run_day_sums(
        _topic(spark, args), args.table, _run(args, "append"), duration=args.duration,
        watermark=args.watermark, dedup=not args.repeats,
    )


def merge_statistics(spark: SparkSession, args: argparse.Namespace) -> None:
    """Statistics of the dates given as "2018-07-05 2018-07-06", from sums by day."""
    sums = tables.read_latest(spark, args.table, DAY_TABLE, DAY_KEY)
    tables.append_statistics(daily.merged_statistics(sums, args.dates.split()), args.statistics)


def correct(spark: SparkSession, args: argparse.Namespace) -> None:
    """Means of windows that late ticks touch, from the table of ticks."""
    corrections.correct(
        spark, args.ticks, args.table, args.corrections, corrections.averaged(args.duration, args.slide),
        MEAN_TABLE, args.duration, args.watermark, args.compacted,
    )


def store_ticks(spark: SparkSession, args: argparse.Namespace):
    return jobs.run_store_ticks(
        _topic(spark, args), args.table, args.quarantine, _run(args, "append"), args.view
    )


def store_results(spark: SparkSession, args: argparse.Namespace):
    return jobs.run_store_results(_topic(spark, args), args.table, _run(args, "append"), args.kind)


def gather_statistics(spark: SparkSession, args: argparse.Namespace) -> None:
    """Statistics of the dates given as "2018-07-05 2018-07-06"; of one marker, or of all."""
    dates = args.dates.split()
    history = tables.read_latest(spark, args.history, TICK_TABLE, TICK_KEY, compacted=args.compacted)
    if args.marker:
        stats = counts.marker_statistics(history, args.marker, dates, args.duration)
    else:
        stats = counts.all_statistics(history, dates, args.duration)
    tables.append_statistics(stats, args.statistics)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.compact(spark, args.table, args.target, *TABLES[args.kind], upto=args.upto, full=args.full)


def prune(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.prune(spark, args.table, args.target, args.keep)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ratewatch")
    commands = top.add_subparsers(required=True)

    def add(name: str, run, stream: bool = True) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        if stream:
            command.add_argument("--topic", required=True)
            command.add_argument("--format", default="parquet")
            command.add_argument("--option", action="append", default=[])
            command.add_argument("--checkpoint", required=True)
            command.add_argument("--mode", choices=["append", "update"])
            command.add_argument("--every", help='trigger, such as "1 second"')
            command.add_argument("--once", action="store_true")
            command.add_argument("--state-partitions", type=int)
            command.add_argument("--since", help="leave out messages before this time, as 2018-07-05T08:00:00+00:00")
            command.add_argument("--most", type=int, help="files (Kafka: messages) a batch")
            command.add_argument("--most-bytes", type=int, help="bytes of files a batch")
        return command

    command = add("publish", publish)
    command.add_argument("--responses", required=True)
    command.add_argument("--quarantine")
    command.add_argument("--partitions", type=int)
    for name, run, duration, watermark in (
        ("sliding-mean", sliding_mean, 30, 120),
        ("count-anomalies", count_anomalies, 10, 60),
    ):
        command = add(name, run)
        target = command.add_mutually_exclusive_group(required=True)
        target.add_argument("--table")
        target.add_argument("--out-topic")
        command.add_argument("--out-partitions", type=int, help="default: the session's shuffle partitions")
        command.add_argument("--duration", type=int, default=duration, help="seconds")
        command.add_argument("--watermark", type=int, default=watermark, help="seconds")
        if name == "sliding-mean":
            command.add_argument("--slide", type=int, default=5, help="seconds")
        else:
            command.add_argument("--statistics", required=True)
            command.add_argument("--k", type=float, default=2.0)
            command.add_argument("--marker", action="append")
            command.add_argument(
                "--repeats", action="store_true", help="count repeated ticks, which the tick table does not hold"
            )
            command.add_argument("--silent", action="store_true", help="judge windows without ticks, too")
    command = add("sum-days", sum_days)
    command.add_argument("--table", required=True)
    command.add_argument("--duration", type=int, default=10, help="seconds")
    command.add_argument("--watermark", type=int, default=60, help="seconds")
    command.add_argument("--repeats", action="store_true")
    command = add("merge-statistics", merge_statistics, stream=False)
    command.add_argument("dates")
    command.add_argument("--table", required=True)
    command.add_argument("--statistics", required=True)
    command = add("correct-means", correct, stream=False)
    for name in ("--ticks", "--table", "--corrections"):
        command.add_argument(name, required=True)
    command.add_argument("--compacted")
    command.add_argument("--duration", type=int, default=30, help="seconds")
    command.add_argument("--slide", type=int, default=5, help="seconds")
    command.add_argument("--watermark", type=int, default=120, help="seconds")
    command = add("store-ticks", store_ticks)
    command.add_argument("--table", required=True)
    command.add_argument("--quarantine", required=True)
    command.add_argument("--view")
    command = add("store-results", store_results)
    command.add_argument("--kind", choices=["means", "anomalies"], required=True)
    command.add_argument("--table", required=True)
    command = add("gather-statistics", gather_statistics, stream=False)
    command.add_argument("dates")
    command.add_argument("--history", required=True)
    command.add_argument("--compacted")
    command.add_argument("--statistics", required=True)
    command.add_argument("--marker")
    command.add_argument("--duration", type=int, default=10, help="seconds")
    command = add("compact", compact, stream=False)
    command.add_argument("--kind", choices=list(TABLES), required=True)
    command.add_argument("--table", required=True)
    command.add_argument("--target", required=True)
    command.add_argument("--upto", type=int)
    command.add_argument("--full", action="store_true", help="merge earlier compactions, too")
    command = add("prune", prune, stream=False)
    command.add_argument("--table", required=True)
    command.add_argument("--target", required=True)
    command.add_argument("--keep", type=int, default=tables.KEEP_SECONDS, help="seconds")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("ratewatch").getOrCreate())
    query = args.run(spark, args)
    if query is not None:
        query.awaitTermination()
