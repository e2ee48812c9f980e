"""Every registered query against its SQL, over the smallest data set."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    message = oracle.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert message in ("", "no rows"), message
