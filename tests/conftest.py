import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from concordat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows as a DataFrame, and a DataFrame as a sorted list of tuples."""

    class Rows:
        def __call__(self, schema, *values):
            return spark.createDataFrame(list(values), schema)

        def of(self, frame, *columns):
            return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=repr)

    return Rows()
