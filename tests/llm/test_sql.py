"""Queries of the operators against their SQL, on the smallest tables."""

import os

import pytest

from labelloom.llm.queries import QUERIES, SQL
from tests.oracle import connect, rows_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(SQL[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == theirs
    assert theirs[1]
