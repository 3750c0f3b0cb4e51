import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from surgelens.session import build_session

    session = build_session("surgelens-tests", master="local[4]", cpus=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def fresh(spark):
    """A new path per call, under the session's shared folder."""
    from surgelens.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
