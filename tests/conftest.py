from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.schemas import RAW_SCHEMA  # noqa: E402
from strata.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(app_name="strata-tests", master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def raw_rows(spark):
    """Build an all-text raw frame (6 business columns) from tuples."""

    def make(rows):
        return spark.createDataFrame(rows, schema=RAW_SCHEMA)

    return make


def has_testdata(sf_dir: str) -> bool:
    return os.path.exists(os.path.join(sf_dir, "orders.parquet"))
