"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from footfall.plans import oracles, registry
from tests.oracle import TESTDATA, compare, connect

SF = f"{TESTDATA}/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name in registry.queries()}
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert compare(ours, duck.execute(SQL[name]).fetchdf()) == ""
    else:
        assert len(ours) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["store_id", "camera_id", "ts_minute"]
    assert df.count() > 0
