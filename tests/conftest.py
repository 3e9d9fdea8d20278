import datetime as dt
import os
import sys

import pytest
from pyspark import cloudpickle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import clients  # noqa: E402

cloudpickle.register_pickle_by_value(clients)  # workers do not have the tests on their path

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session

    s = get_session("local[4]", app_name="eventide-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def content_seed(spark):
    """A small catalogue: every content type, with and without a length."""
    from eventide.schemas import CONTENT
    kinds = [("video", 2400), ("newsletter", None), ("podcast", 1800), ("video", 90)]
    day = dt.datetime(2024, 1, 1)
    rows = [(f"11111111-1111-4111-8111-{i:012d}", f"{kind}-{i}", f"Item {i}", kind, length, day)
            for i, (kind, length) in enumerate(kinds, 1)]
    return spark.createDataFrame(rows, CONTENT)
