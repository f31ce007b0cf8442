import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: no cluster-provided checkpoint dir, so take a scratch one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="smogcast-test-ckpt-"))
    yield s


def days(n, start=dt.date(2020, 1, 1), skip=()):
    out, d = [], start
    while len(out) < n:
        if d not in skip:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


@pytest.fixture
def series_df(spark):
    """one series, consecutive days 1..8."""
    vals = [40.0, 60.0, 120.0, 180.0, 250.0, 350.0, 450.0, 90.0]
    rows = [("A", d, v) for d, v in zip(days(8), vals)]
    return spark.createDataFrame(rows, "series_key string, Date date, AQI double")
