import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("ratewatch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


BASE = 1_530_000_000_000


@pytest.fixture
def make_ticks(spark):
    """Ticks from (marker, milliseconds after the base time, big figure, points)."""
    from pyspark.sql import functions as F

    def make(*rows):
        full = [(m, None if ms is None else BASE + ms, b, p) for m, ms, b, p in rows]
        schema = "fx_marker string, timestamp_ms bigint, bid_big double, bid_points int"
        return spark.createDataFrame(full, schema).withColumn("ts", F.timestamp_millis("timestamp_ms"))

    return make
