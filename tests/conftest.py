import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.sources.events import EVENT_SCHEMA  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")  # many short jobs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.sql.session.timeZone", "America/New_York")  # must never matter
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def log(spark):
    """Builds an event log from (account, time, type, product) tuples; times as text."""

    def make(*rows):
        full = [(a, dt.datetime.fromisoformat(t), e, p, None) for a, t, e, p in rows]
        return spark.createDataFrame(full, EVENT_SCHEMA)

    return make
