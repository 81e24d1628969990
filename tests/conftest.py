import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from betaloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "betaloom-tests", "6g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


VALUES = "project_id string, sample_id string, probe_id string, value double"


@pytest.fixture
def matrix(rows):
    return lambda cells: rows(cells, VALUES)
