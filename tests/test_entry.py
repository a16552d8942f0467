"""The entry points as a driver calls them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")


def test_entry_returns_a_lazy_frame_with_rows(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:2] == ["buyer_org_id", "current_period_purchases"]
    assert not frame.isEmpty()


def test_names_match():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
