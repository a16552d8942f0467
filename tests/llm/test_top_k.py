from __future__ import annotations

import random

import numpy as np
import pytest

from tradeloom.llm import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every=2):
    good = [(i, np.floor(256 * np.array(v, np.float64))) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-int(a @ b), i) for i, b in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, every=2):
    vectors = top_k.valid_vectors(spark.createDataFrame(rows, SCHEMA))
    return sorted(map(tuple, top_k.search(vectors.where(f"vec_id % {every} = 0"), vectors, k).collect()))


def test_agrees_with_brute_force_on_ties_and_bad_vectors(spark):
    rng = random.Random(1)
    draw = lambda: [np.float32(rng.gauss(0, 1)).item() for _ in range(20)]
    same = draw()
    rows = [(i, same if i % 3 == 0 else draw(), 0) for i in range(150)]
    rows += [(1000, None, 0), (1002, [None] + same[1:], 0), (1004, [float("nan")] + same[1:], 0), (None, same, 0)]
    rows += [(1006, [float("inf")] + same[1:], 0)]
    assert run(spark, rows) == brute(rows, 5)


def test_blocks_of_every_size_agree(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [np.float32(rng.gauss(0, 1)).item() for _ in range(17)], 0) for i in range(90)]
    monkeypatch.setattr(top_k, "CANDIDATES", 7)
    monkeypatch.setattr(top_k, "QUERIES", 5)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    assert run(spark, [(0, [1.0, 0.5], 1), (1, [0.25, -1.0], 1)]) == [(0, 1, 1, 256 * 64 - 128 * 256)]
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, []) == []


def test_repeated_candidates_count_each(spark):
    rows = [(0, [1.0], 0), (1, [1.0], 0), (1, [1.0], 0), (3, [0.5], 0)]
    assert run(spark, rows, 2) == [(0, 1, 1, 65536), (0, 2, 1, 65536)]


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**20, 1.0], 0), (1, [2.0**19, 0.00390625], 0)]
    assert run(spark, rows) == [(0, 1, 1, 2**28 * 2**27 + 256)]


def test_pruning_drops_most_partial_work():
    rng = np.random.default_rng(3)
    candidates = np.floor(256 * rng.standard_normal((500, 32)))
    queries = candidates[:10] * 1.0
    found = list(top_k.search_block(np.arange(10), queries, np.arange(500), candidates, 5))
    want = []
    for q in range(10):
        scores = candidates @ queries[q]
        want += [(q, int(i), int(scores[i])) for i in sorted((i for i in range(500) if i != q), key=lambda i: (-scores[i], i))[:5]]
    assert found == want


@pytest.mark.parametrize("k", [1, 4])
def test_vectors_of_unequal_length_count_missing_as_zero(spark, k):
    rows = [(0, [1.0, 1.0], 0), (1, [1.0], 0), (3, [1.0, 1.0, 5.0], 0)]
    assert run(spark, rows, k) == [(0, 1, 3, 2 * 65536), (0, 2, 1, 65536)][:k]
