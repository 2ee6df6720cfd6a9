from __future__ import annotations

import os
import sys
import time
import uuid

import pytest

# Timestamps are written in these tests as the driver's local time.
os.environ.setdefault("TZ", "UTC")
time.tzset()

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from datamove.layout import Layout, Place  # noqa: E402
from datamove.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": str(warehouse)}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data at {SF_DIR}")
    return SF_DIR


@pytest.fixture
def place(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    return Place(f"{tmp_path}/thing", database, "thing", "thing_tv")


@pytest.fixture
def layout(tmp_path):
    return Layout(root=f"{tmp_path}/", env=f"e{uuid.uuid4().hex[:8]}")


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
