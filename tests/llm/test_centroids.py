"""Sharded Lloyd's rounds against plain ones in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tests.llm.tables import with_strange_columns
from tradeloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, width):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v, _ in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    model = [list(v) for _, v in seeds]
    if not model:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(model))

    for _ in range(rounds):
        chosen = [nearest(v)[1] for _, v in kept]
        for c in range(len(model)):
            mine = [v for (_, v), n in zip(kept, chosen, strict=True) if n == c]
            if mine:
                model[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in model]
    return sorted(((i, c, d, sum(e for _, e, n in found if n == c), total, digest[c]) for i, d, c in found), key=repr)


def run(frame, **settings):
    return sorted((tuple(r) for r in centroids.cluster(frame, **settings).collect()), key=repr)


def draw(rng, width):
    return [np.float32(rng.gauss(0, 1)).item() for _ in range(width)]


@pytest.mark.parametrize("columns", [16, 5, 64])
def test_agrees_with_plain_rounds_on_ties_copies_and_bad_vectors(spark, columns):
    rng = random.Random(columns)
    same = draw(rng, 20)
    rows = [(i, same if i % 3 == 0 else draw(rng, 20), 0) for i in range(150)]
    rows += [(7, draw(rng, 20), 0), (7, same, 0), (7, same, 0), (None, draw(rng, 20), 0), (None, same, 0)]
    rows += [(1000, None, 0), (1001, [None] + same[1:], 0), (1002, [float("nan")] + same[1:], 0), (1003, same[1:], 0)]
    rows += [(1004, [float("inf")] + same[1:], 0), (1005, same + [0.0], 0), (1006, [], 0)]
    frame = with_strange_columns(spark.createDataFrame(rows, SCHEMA), "cluster", "grp", "shard", "x", "ids")
    assert run(frame, k=6, width=20, columns=columns) == brute(rows, 6, 3, 20)


def test_a_third_of_the_rows_with_one_vector_and_id(spark):
    rng = random.Random(2)
    same = draw(rng, 64)
    rows = [(5, same, 0) if i % 3 == 0 else (i, draw(rng, 64), 0) for i in range(300)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(7)) == brute(rows, 16, 3, 64)


def test_empty_centroids_stay(spark):
    rows = [(1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [5.0, 5.0], 0)]
    found = run(spark.createDataFrame(rows, SCHEMA), k=3, width=2)
    assert found == brute(rows, 3, 3, 2)
    assert {r[1] for r in found} <= {0, 1, 2} and len({r[1] for r in found}) == 2


def test_few_vectors_and_empty_tables(spark):
    rows = [(1, [0.5, -0.25], 1), (2, [0.5, 7.0], 1)]
    assert run(spark.createDataFrame(rows, SCHEMA), width=2) == brute(rows, 16, 3, 2)
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(None, [1.0, 2.0], 0)], SCHEMA), width=2) == []


def test_components_that_could_overflow_raise(spark):
    with pytest.raises(Exception, match="a component beyond"):
        run(spark.createDataFrame([(1, [1e9, 0.0], 0)], SCHEMA), width=2)


def test_vectors_are_shuffled_once(spark):
    rows = [(i, [float(i), float(-i)], 0) for i in range(40)]
    table = centroids.tiles(centroids.kept(spark.createDataFrame(rows, SCHEMA), 2), 64, 1)
    model = centroids.Lloyd(spark, table, np.array([[0, 0], [64, 64]]), 1)
    chosen = model.assign()
    back = chosen.flatMap(lambda c: [((s, c[0]), c[1][0]) for s in range(2)]).partitionBy(model.groups, model.deal)
    assert model.tiles.union(back).getNumPartitions() == model.tiles.getNumPartitions()
