from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from hackney.schemas import TRIPS, ZONES  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="hackney-test-ckpt-")
    session = (SparkSession.builder.master("local[*]")
               .appName("hackney-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", ckpt)
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="hackney-test-")


def ts(text: str | None):
    return None if text is None else dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def make_trips(spark, rows: list[dict]):
    """A trips DataFrame from partial dicts; missing columns are NULL."""
    names = TRIPS.fieldNames()
    data = []
    for r in rows:
        r = dict(r)
        for k in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            if isinstance(r.get(k), str):
                r[k] = ts(r[k])
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, TRIPS)


def make_zones(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, ZONES)
