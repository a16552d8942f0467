"""Exact top-k search by inner product: columnar branch and bound in blocks.

Candidates and queries are dealt into blocks of bounded size by hashes of their ids, and each pair of blocks meets in one
task. There the candidates stand in vertical layout (one row per dimension). Scores are accumulated dimension block by
dimension block; after each, a candidate can gain at most the product of the two remaining masses (norms of the
dimensions not yet seen, by Cauchy and Schwarz). Candidates that cannot reach the k-th best score so far are dropped and
the survivors' columns compacted. Dimension blocks come in order of the query block's mass, so bounds fall early.
Per block pair and query at most k results leave a task; the k best over all blocks follow by rank.

Scores are integers: components are floor(scale * x). They are added as doubles while every sum stays below 2**53,
else as Python integers, so they are exact; a score that does not fit a long raises an error.

Defined results: vectors that are null or hold null or non-finite components take no part (an empty vector has score 0
with all); of vectors of unequal length the missing components count as 0; rows without an id take no part; equal scores
go to the smaller id; repeated candidates count each, of queries that share an id the largest vector is asked; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import blocks_for, ship

#: Vectors in a block of candidates and of queries, and dimensions accumulated at a time.
CANDIDATES, QUERIES, DIMENSIONS = 4096, 1024, 8
#: Candidates scored whole to start a query's bound.
SEEDS = 64

RESULT = "query_id long, vec_id long, score long"


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id and x, the components as doubles, of the vectors that take part."""
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))
    return table.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))


def _matrix(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return np.floor(scale * out)


def search_block(query_ids, queries, ids, candidates, k: int) -> Iterator[tuple[int, int, int]]:
    """The k best candidates of each query other than itself: (query id, candidate id, score)."""
    order = np.argsort(ids, kind="stable")
    ids, candidates = ids[order], candidates[order]
    top = max(np.abs(queries).max(initial=0), 1) * max(np.abs(candidates).max(initial=0), 1) * queries.shape[1]
    if top >= 2**53:
        queries, candidates = (np.array([[int(v) for v in row] for row in m], object) for m in (queries, candidates))
        scores = queries @ candidates.T
        for q, row in enumerate(scores):
            for i in sorted((i for i in range(len(ids)) if ids[i] != query_ids[q]), key=lambda i: (-row[i], ids[i]))[:k]:
                yield int(query_ids[q]), int(ids[i]), int(row[i])
        return
    mass = (queries**2).sum(axis=0)
    dims = np.argsort(-mass, kind="stable")
    queries, columns = queries[:, dims], np.ascontiguousarray(candidates[:, dims].T)
    cuts = [slice(i, i + DIMENSIONS) for i in range(0, len(dims), DIMENSIONS)]
    # Remaining mass after each dimension block, a little enlarged against rounding.
    left_q = np.array([np.sqrt((queries[:, c.stop :] ** 2).sum(axis=1)) for c in cuts]) * (1 + 1e-9)
    left_c = np.array([np.sqrt((columns[c.stop :] ** 2).sum(axis=0)) for c in cuts]) * (1 + 1e-9)
    for q, vector in enumerate(queries):
        alive = np.flatnonzero(ids != query_ids[q])
        if not len(alive):
            continue
        seeds = alive[: max(SEEDS, k)]
        first = np.sort(vector @ columns[:, seeds])
        floor = first[-k] if len(first) >= k else -np.inf
        scores, part = np.zeros(len(alive)), columns[:, alive] if len(alive) < len(ids) else columns
        for i, cut in enumerate(cuts):
            scores = scores + vector[cut] @ part[cut]
            bound = left_q[i, q] * left_c[i][alive]
            if len(alive) > k:  # every candidate ends at or above its score less its bound
                floor = max(floor, np.partition(scores - bound, len(alive) - k)[len(alive) - k])
            going = scores + bound >= floor - 1e-6
            if going.sum() * 4 < len(alive) * 3:
                alive, scores, part = alive[going], scores[going], part[:, going]
        best = np.lexsort((ids[alive], -scores))[:k]
        for i in best:
            yield int(query_ids[q]), int(ids[alive[i]]), int(scores[i])


def search(queries: DataFrame, candidates: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products among the candidates but itself.
    Both frames hold vec_id and x, as `valid_vectors` makes them."""
    ship(queries.sparkSession)
    queries = queries.groupBy("vec_id").agg(F.max("x").alias("x"))
    n_candidates, n_queries = candidates.count(), queries.count()
    left, right = blocks_for(n_queries, QUERIES), blocks_for(n_candidates, CANDIDATES)

    def dealt(frame: DataFrame, own: int, other: int, mine: str, others: str) -> DataFrame:
        return frame.withColumn(mine, F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("int")).withColumn(
            others, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        )

    q = dealt(queries, left, right, "left", "right")
    c = dealt(candidates, right, left, "right", "left")

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        if len(q) and len(c):
            width = max(max(map(len, q.x)), max(map(len, c.x)), 1)
            rows = list(search_block(q.vec_id.to_numpy(), _matrix(q.x, width, scale), c.vec_id.to_numpy(), _matrix(c.x, width, scale), k))
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = q.groupBy("left", "right").cogroup(c.groupBy("left", "right")).applyInPandas(run, RESULT)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
