"""Stored tables: partitioned by marker and date, newest first, last write wins.

A stream writes each micro-batch to a folder of its own, ``batch_id=N``, in overwrite
mode: a batch that runs again replaces itself. It is not split by marker and date there,
which would make very many small files; as a batch covers little time, the files'
statistics do for skipping. Readers take the row of the latest batch per key. ``compact``
brings the batches since the last compaction into the partitioned layout and records which
they are; readers then leave these batches out.
"""

from __future__ import annotations

from datetime import date
from itertools import pairwise
from time import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewatch.operators.counts import on_dates
from ratewatch.operators.latest import latest
from ratewatch.operators.serving import of_markers
from ratewatch.operators.ticks import with_record_id
from ratewatch.schemas import DAY_TABLE, STATISTICS_TABLE, columns, versioned
from ratewatch.session import stored

PARTITIONS = ("fx_marker", "timestamp_d")

# What something newer has replaced stays for so many seconds, for its readers.
KEEP_SECONDS = 3600

# What a compaction holds: the batches behind one, up to another.
POINTER = columns(run="bigint", after="bigint", upto="bigint")


def write_table(
    rows: DataFrame, path: str, newest: str = "timestamp_ms", mode: str = "append",
    file_rows: int = 0,
) -> None:
    """Write rows partitioned by marker and date, each file newest first.

    Rows are brought together by partition so that files are few and large. The hint is
    "rebalance" and not a plain repartition: adaptive execution then splits a marker-day
    that is too large for one task. ``file_rows`` bounds the rows of a file (0: no bound).
    """
    together = rows.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    ordered = together.sortWithinPartitions(*PARTITIONS, F.desc(newest))
    writer = ordered.write.mode(mode).option("maxRecordsPerFile", file_rows)
    writer.partitionBy(*PARTITIONS).parquet(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str
) -> DataFrame:
    """A stored table. The declared schema keeps markers text, also all-digit ones.

    Other table formats (a Cassandra connector, say) are named by ``format`` and
    ``options``; they bring their own schema.
    """
    if format == "parquet":
        return spark.read.schema(schema).parquet(path)
    return spark.read.format(format).options(**options).load()


def append_statistics(stats: DataFrame, path: str) -> None:
    """Add gathered statistics to the history, and renew the small table of the newest ones.

    The history is partitioned by the day they were gathered and not by marker, so that a run
    adds few files. The newest are made from those before and the new ones; each run writes
    them to a folder of its own, and readers take the last.
    """
    spark = stats.sparkSession
    runs = numbers(spark, f"{path}/newest", "run")
    new = stored(stats.select(*STATISTICS_TABLE.names), "statistics")
    days = new.withColumn("day", F.to_date("stat_gathered_date"))
    together = days.hint("rebalance", F.col("day"))
    together.write.mode("append").partitionBy("day").parquet(f"{path}/history")
    every = new.unionByName(newest_statistics(spark, path)) if runs else new
    newest = latest(every, ("fx_marker",), "stat_gathered_date").select(*STATISTICS_TABLE.names)
    newest.hint("rebalance").write.mode("overwrite").parquet(f"{path}/newest/run={max(runs, default=-1) + 1}")
    drop_older(spark, f"{path}/newest", "run", KEEP_SECONDS)


def newest_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The statistics gathered last for each marker, as of now."""
    runs = numbers(spark, f"{path}/newest", "run")
    if not runs:
        return spark.createDataFrame([], STATISTICS_TABLE)
    return spark.read.schema(STATISTICS_TABLE).parquet(f"{path}/newest/run={max(runs)}")


def statistics_history(spark: SparkSession, path: str) -> DataFrame:
    """All statistics ever gathered."""
    return spark.read.schema(STATISTICS_TABLE).parquet(f"{path}/history")


def write_days(sums: DataFrame, path: str) -> None:
    """Put the sums of whole days in place of what the table holds of these days."""
    together = sums.select(*DAY_TABLE.names).hint("rebalance", F.col("day"))
    writer = together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the complete folders ``name``=N in a folder, in any store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    made = [str(status.getPath().getName()) for status in files.listStatus(folder)]
    done = [x for x in made if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{x}/_SUCCESS"))]
    return [int(x.partition("=")[2]) for x in done if x.startswith(f"{name}=")]


def _age(spark: SparkSession, folder: str) -> float:
    """Seconds since a folder was complete."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    files = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return time() - files.getFileStatus(mark).getModificationTime() / 1000


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_older(spark: SparkSession, path: str, name: str, seconds: int) -> None:
    """Remove folders ``name``=N that a newer one has followed for so long."""
    for old, newer in pairwise(sorted(numbers(spark, path, name))):
        if _age(spark, f"{path}/{name}={newer}") > seconds:
            _remove(spark, f"{path}/{name}={old}")


def write_version(rows: DataFrame, path: str, batch_id: int, order: tuple[str, ...] = ()) -> None:
    """Write one micro-batch; running it again replaces what it wrote before.

    With an ``order`` each file is sorted by these columns and has a Bloom filter on the
    first, so a reader of one marker opens few row groups, and of these few pages.
    """
    writer = (rows.sortWithinPartitions(*order) if order else rows).write.mode("overwrite")
    if order:
        writer = writer.option(f"parquet.bloom.filter.enabled#{order[0]}", "true")
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_version(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows that one micro-batch wrote."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")


def compactions(spark: SparkSession, compacted: str) -> list[tuple[int, int, int]]:
    """(run, after, upto) of the compactions that together hold all batches up to the last.

    Each holds the batches behind ``after`` up to ``upto``; the newest comes first. There is
    one row a compaction, written when its data is complete.
    """
    runs = _pointers(spark, compacted)
    chain: list[tuple[int, int, int]] = []
    for run, after, upto in sorted(runs, reverse=True):
        if not chain or upto == chain[-1][1]:
            chain.append((run, after, upto))
            if after < 0:
                break
    return chain


def _pointers(spark: SparkSession, compacted: str) -> list[tuple[int, int, int]]:
    path = f"{compacted}/pointers"
    made = [f"{path}/at={n}" for n in numbers(spark, path, "at")]
    return [tuple(r) for r in spark.read.schema(POINTER).parquet(*made).collect()] if made else []


def prune(spark: SparkSession, path: str, compacted: str, keep: int = KEEP_SECONDS) -> None:
    """Remove batches that a compaction holds, and compactions that a full one has replaced.

    What replaces them must be complete for ``keep`` seconds, so that readers that began
    before have ended. A table that is compacted and pruned from time to time lists no folder
    of long ago; the rows that it gives stay the same.
    """
    chain = compactions(spark, compacted)
    settled = [c for c in chain if _age(spark, f"{compacted}/pointers/at={c[0]}") > keep]
    if not settled:
        return
    upto, kept = max(c[2] for c in settled), {run for run, _, _ in chain}
    for batch in numbers(spark, path, "batch_id"):
        if batch <= upto:
            _remove(spark, f"{path}/batch_id={batch}")
    if settled[0] == chain[0]:
        for run, _, _ in _pointers(spark, compacted):
            if run not in kept:
                # The pointer goes first: without it nobody looks for the data.
                _remove(spark, f"{compacted}/pointers/at={run}")
                _remove(spark, f"{compacted}/data/run={run}")


def _held(spark: SparkSession, compacted: str, schema: T.StructType, runs: list[int]) -> DataFrame:
    fields = [*versioned(schema).fields, T.StructField("run", T.LongType())]
    rows = spark.read.schema(T.StructType(fields)).parquet(f"{compacted}/data")
    return rows.where(F.col("run").isin(runs)).drop("run")


def read_versions(spark: SparkSession, path: str, schema: T.StructType, compacted: str | None = None) -> DataFrame:
    """All versions of all rows: batches, and for those that it holds the compacted copy.

    Which batches the copy holds is read from the copy itself.
    """
    versions = spark.read.schema(versioned(schema)).parquet(path)
    chain = compactions(spark, compacted) if compacted else []
    if not chain:
        return versions
    newer = versions.where(F.col("batch_id") > chain[0][2])
    return newer.unionByName(_held(spark, compacted, schema, [run for run, _, _ in chain]))


def newest_dates(rows: DataFrame, dates: list[date | str], n: int) -> list[str]:
    """The newest of the dates that together hold ``n`` rows, or all of them.

    For the newest rows of a partitioned table: only these dates need be read. Twice as many
    dates are counted each time, which takes the files' own row numbers and no column.
    """
    ordered = sorted((str(day) for day in dates), reverse=True)
    size = 1
    while size < len(ordered) and on_dates(rows, ordered[:size]).count() < n:
        size *= 2
    return ordered[:size]


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...],
    markers: str | list[str] | None = None, dates: list[date | str] | None = None,
    compacted: str | None = None, record_id: bool = False,
) -> DataFrame:
    """The current rows of a versioned table, with ``batch_id``.

    Markers and dates are parts of the key, so they are filtered before the versions are
    compared. ``record_id`` is made from the key on reading and needs no storage.
    """
    versions = read_versions(spark, path, schema, compacted)
    if markers is not None:
        versions = of_markers(versions, markers)
    if dates is not None:
        versions = on_dates(versions, dates)
    rows = latest(versions, keys, "batch_id")
    return with_record_id(rows, keys) if record_id else rows


def compact(
    spark: SparkSession, path: str, target: str, schema: T.StructType, keys: tuple[str, ...],
    upto: int | None = None, file_rows: int = 0, full: bool = False,
) -> None:
    """Bring the batches since the last compaction, up to batch ``upto``, into the table layout.

    Only these are read and written, so the cost does not grow with the history. ``full``
    merges all compactions with them into one; run it from time to time. Every compaction
    has a folder of its own, and a row that names it once it is complete: a reader sees the
    state before or after, never a part, and a compaction that is lost is done again. Batches
    that it holds are not read any more; ``prune`` removes them, and compactions that a full
    one has replaced. Run one compaction of a table at a time.
    """
    chain = compactions(spark, target)
    last = chain[0][2] if chain else -1
    after = -1 if full else last
    batches = spark.read.schema(versioned(schema)).parquet(path).where(F.col("batch_id") > last)
    if upto is not None:
        batches = batches.where(F.col("batch_id") <= upto)
    newest = batches.agg(F.max("batch_id")).first()[0]
    if newest is None and not (full and len(chain) > 1):
        return
    newest = last if newest is None else newest
    rows = batches.where(F.col("batch_id") <= newest)
    if full and chain:
        rows = rows.unionByName(_held(spark, target, schema, [run for run, _, _ in chain]))
    run = 1 + max((r for r, _, _ in _pointers(spark, target)), default=-1)
    write_table(latest(rows, keys, "batch_id"), f"{target}/data/run={run}", keys[-1], "overwrite", file_rows)
    pointer = spark.createDataFrame([(run, after, newest)], POINTER)
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{target}/pointers/at={run}")
