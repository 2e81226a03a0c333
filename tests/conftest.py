import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import verify  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return verify.session("4")


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def pytest_configure(config):
    config.addinivalue_line("markers", "oracle: compares a query with its SQL")
