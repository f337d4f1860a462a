"""Every registered query next to its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 28
