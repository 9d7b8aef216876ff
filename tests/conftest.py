import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus="8", **{"spark.default.parallelism": "2"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of the physical plan of a frame."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
