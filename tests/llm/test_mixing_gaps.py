"""Gaps that a long document at the cut leaves, and rows of equal id and text."""

from __future__ import annotations

import pytest

from tests.llm.tables import documents, prose
from tradeloom.llm import mixing

GOAL = {"a": 2560, "b": 3840}


def shares(names):
    return {n: GOAL[n] for n in names}


@pytest.mark.parametrize("seed", range(4))
def test_a_long_document_leaves_no_gap(spark, seed):
    """One document of 600 words and 100 of 10, to be taken 1.6 times."""
    texts = [prose(0, 600)] + [prose(i, 10) for i in range(1, 101)] + [prose(i, 48) for i in range(200, 300)]
    frame = documents(spark, texts, sources=["a"] * 101 + ["b"] * 100)
    rows = mixing.taken(frame, weights=shares, settings=mixing.Settings(seed=seed)).collect()
    assert rows[0]["target"] is not None
    for s, size in (("a", 10), ("b", 48)):
        own = [r for r in rows if r["doc_id"] <= 100] if s == "a" else [r for r in rows if r["doc_id"] > 100]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < size
        assert {r["copies"] for r in own} == ({1, 2} if s == "a" else {0, 1})


@pytest.mark.parametrize("seed", range(4))
def test_equal_rows_count_by_their_sum(spark, seed):
    """Groups of six equal rows of 10 words beside single ones of 7, and a long document."""
    texts = [prose(0, 600)] + [prose(1 + i // 6, 10) for i in range(60)] + [prose(500 + i, 7) for i in range(100)]
    ids = [0] + [1 + i // 6 for i in range(60)] + list(range(500, 600))
    frame = documents(spark, texts + [prose(9999, 3000)], sources=["a"] * 161 + ["b"], ids=ids + [9999])
    rows = mixing.taken(frame, weights=lambda names: {"a": 3040, "b": 1860}, settings=mixing.Settings(seed=seed)).collect()
    own = [r for r in rows if r["doc_id"] != 9999]
    assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 7
    assert len({(r["doc_id"], r["copies"]) for r in own}) == 111
