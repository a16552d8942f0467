"""Every registered query against DuckDB on the smallest test tables."""

from __future__ import annotations

import os

import pytest

from tests.oracle import compare, connect
from tradeloom.checks import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    assert compare(registry.QUERIES[name](spark, FOLDER), duck, registry.ORACLES[name]) is None
