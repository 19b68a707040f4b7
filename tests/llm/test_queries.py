"""Every corpus query on the smallest tables, against its SQL twin where it has one."""

import pytest

from footfall.llm import queries as corpus
from tests.oracle import TESTDATA, compare, connect

SF = f"{TESTDATA}/sf0.001"
QUERIES, SQL = corpus.queries(), corpus.oracle_sql()


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert len(ours) > 0
    if name in SQL:
        assert compare(ours, connect(SF).execute(SQL[name]).fetchdf()) == ""
