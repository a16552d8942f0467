"""The registered queries against DuckDB on the smallest tables, and their entry points."""

from __future__ import annotations

import os

import pytest

from tests.oracle import compare, connect
from tradeloom.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), duck, queries.ORACLES[name]) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
