import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isohyet.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def cube(spark):
    """make(rows) with rows of (time, lat, lon, tas, pr)."""
    def make(rows, extra=()):
        schema = "time timestamp_ntz, lat double, lon double, tas double, pr double"
        for name in extra:
            schema += f", {name} string"
        return spark.createDataFrame(rows, schema)

    return make


def day(year, month, d=1):
    return datetime(year, month, d)


def plan_of(df):
    """The physical plan as text, after adaptive execution has not yet run."""
    return df._jdf.queryExecution().executedPlan().toString()
