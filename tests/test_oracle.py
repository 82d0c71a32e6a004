"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from labelloom.catalog import QUERIES, SQL
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# It runs the four surveys, each of which is compared by itself, once more.
REPEATED = {"family_winners"}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(SQL) - REPEATED))
def test_query_matches_sql(spark, connection, name):
    ok, note = compare(spark, connection, FOLDER, name)
    assert ok, note


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
