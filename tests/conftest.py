import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from reviewloom import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CORRECTNESS = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    logs = tmp_path_factory.mktemp("event-log")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("reviewloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{logs}")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    found = session.configure(builder).getOrCreate()
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture
def rows_of():
    """Rows as sorted tuples, in the given or the frame's column order."""

    def collect(frame, *columns):
        names = columns or frame.columns
        return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)

    return collect
