import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluiceway.session import build_session, scratch_dir  # noqa: E402
from sluiceway.sinks.dataset import Dataset  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")  # plans are compared as text
    yield session
    session.stop()


@pytest.fixture
def dataset(spark):
    return Dataset(spark, scratch_dir(spark, "test"))


@pytest.fixture(scope="session")
def sf():
    return SF
