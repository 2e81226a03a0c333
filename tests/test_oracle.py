"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from checks import ORACLE, QUERIES
import verify

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return verify.oracle(SF)


@pytest.mark.oracle
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert verify.compare(spark, con, SF, name) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["chunk_id", "record"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
