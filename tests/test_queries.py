import pytest
from oracle import TESTDATA, connect, differences

import __spark_entry__ as entry

FOLDER = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(entry._own_queries()) == set(entry._own_sql())


@pytest.mark.parametrize("name", list(entry._own_queries()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(spark, con, name, entry._own_queries()[name], entry._own_sql()[name], FOLDER) == []


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns == ["keyword", "n"] and df.count() > 0
