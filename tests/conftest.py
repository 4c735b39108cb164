import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(params=["plain", "sliced"])
def both_ways(request, spark):
    """Run a test with plain windows and joins, and with slicing and salting forced."""
    spark.conf.set("spark.tidewater.plainRows", "0" if request.param == "sliced" else "1000000")
    yield request.param
    spark.conf.unset("spark.tidewater.plainRows")


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
