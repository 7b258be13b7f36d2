"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Fix the time zone: dates, JSON timestamps and windows are all read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Set session options for the length of a block, then put the old values back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back on a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ratewatch-")
    return _local_folders[app]


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of its own for one run."""
    return f"{shared_folder(spark)}/ratewatch/{name}-{uuid.uuid4().hex}"


# Shuffle files of a query are removed when it has ended, and not when the driver's JVM
# happens to collect what refers to them.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}


def stored(df: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and, as the files have a known size, lets Spark choose a
    broadcast join only where the real size is under its threshold. ``plain`` is for hashes,
    which neither a dictionary nor compression makes much smaller.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    with settings(spark, TIDY):
        (df.write.options(**PLAIN) if plain else df.write).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def forget(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote for these frames.

    Only for frames that nothing reads any more: all that was made of them must be written,
    as a lost executor would have Spark read them again.
    """
    for frame in frames:
        folder = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        folder.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
