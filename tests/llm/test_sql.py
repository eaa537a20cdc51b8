"""Queries of the training-data operators next to their SQL."""

import pytest

from checks.compare import connect, rows_of
from pitchlake.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    oracle = con.sql(SQL[name])
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(list(oracle.columns), oracle.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert [x for x in zip(got[1], want[1], strict=True) if x[0] != x[1]][:2] == []
