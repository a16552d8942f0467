"""Centroid clustering: Lloyd's rounds over vectors that are sharded by dimension.

Vectors are cut into blocks of columns. A tile holds one block of a thousand vectors or so; tiles are dealt to tasks by
their shard, so a task needs the centroids' slice of its own columns only, however many dimensions there are. In a
round each tile gives the exact squared distances of its columns to all centroids' slices; reduceByKey adds the blocks of
the same vectors and takes the nearest centroid; the choices go back to the tiles, and each shard adds up its columns
by centroid and updates its own slice. Tiles stay where their shuffle put them: a round moves distances and choices,
never vectors. Lineage does not grow with the rounds, as each starts from the tiles and the slices.

Components are integers floor(scale * x), and everything is added as integers, so results do not depend on the order. The
driver holds the centroids (k times the dimensions, whose product is checked), and nothing that grows with the rows.

Defined results: only vectors of exactly `width` components take part, none of them null or non-finite; seeds are the
vectors with the smallest hash of their id, of equal hashes the smaller vector; vectors without an id are clustered,
but are no seeds; repeated rows count each, and if they are seeds, the copies with larger numbers stay empty where they
are; with fewer vectors than centroids each vector is a seed; a component beyond 2**27 in size raises an error, as sums of squares need not
fit a long then; further columns are ignored; an empty table, or one without a seed, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import blocks_for, ship, written

#: Columns in a shard, tiles in a task, and the largest component and model (numbers in all centroids).
COLUMNS, TILES, LARGEST, MODEL = 16, 64, 2**27, 2**24

TILE = "grp long, shard int, ids array<long>, cells binary"


def kept(table: DataFrame, width: int) -> DataFrame:
    """vec_id and x, the components as doubles, of the vectors that take part."""
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    good = (F.size("embedding") == width) & F.coalesce(fine, F.lit(False))
    return table.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))


def seeds(vectors: DataFrame, k: int, scale: int) -> np.ndarray:
    """The first centroids, in order."""
    by_hash = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where(F.col("vec_id").isNotNull()).orderBy(by_hash, "x").limit(k).select("x").collect()
    return np.floor(scale * np.array([r.x for r in first], np.float64)).astype(np.int64)


def tiles(vectors: DataFrame, scale: int, columns: int = COLUMNS) -> DataFrame:
    """The vectors cut into tiles, written. A group of vectors has a tile for each shard; the first holds their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            x = batch.column("x")
            cells = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            if np.abs(cells).max() > LARGEST:
                raise ValueError(f"a component beyond {LARGEST} in size")
            cells = cells.astype(np.int32)
            ids, group = batch.column("vec_id").to_pylist(), (task << 32) + number
            starts = range(0, cells.shape[1], columns)
            yield pa.RecordBatch.from_pydict(
                {
                    "grp": pa.array([group] * len(starts), pa.int64()),
                    "shard": pa.array(range(len(starts)), pa.int32()),
                    "ids": pa.array([ids if i == 0 else None for i in starts], pa.list_(pa.int64())),
                    "cells": pa.array([np.ascontiguousarray(cells[:, i : i + columns]).tobytes() for i in starts], pa.binary()),
                }
            )

    return written(vectors.mapInArrow(cut, TILE), "tiles")


class ByShard:
    """Deals the tiles of a shard to partitions of its own."""

    def __init__(self, per_shard: int):
        self.per_shard = per_shard

    def __call__(self, key: tuple[int, int]) -> int:
        shard, group = key
        return shard * self.per_shard + ((group >> 32) + group) % self.per_shard


def distances(cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centroid in these columns."""
    out = np.empty((len(cells), len(centroids)), np.int64)
    cells = cells.astype(np.int64)
    for c, centroid in enumerate(centroids):
        apart = cells - centroid
        out[:, c] = np.einsum("ij,ij->i", apart, apart)
    return out


def nearest(summed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (of equal ones the first) and its distance."""
    chosen = summed.argmin(axis=1)
    return chosen.astype(np.int32), summed[np.arange(len(summed)), chosen]


def added(cells: np.ndarray, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows by centroid, and their counts, as unbounded integers."""
    sums = np.zeros((k, cells.shape[1]), np.int64)
    np.add.at(sums, chosen, cells)
    return sums.astype(object), np.bincount(chosen, minlength=k).astype(object)


class Lloyd:
    """The tiles, dealt once, and the slices of the centroids."""

    def __init__(self, spark: SparkSession, table: DataFrame, start: np.ndarray, columns: int = COLUMNS):
        self.context = spark.sparkContext
        self.k, width = start.shape
        if start.size > MODEL:
            raise ValueError(f"more than {MODEL} numbers in the centroids")
        self.slices = [start[:, i : i + columns] for i in range(0, width, columns)]
        shards = len(self.slices)
        self.deal = ByShard(blocks_for(table.where("shard = 0").count(), TILES))
        self.groups = self.deal.per_shard * shards
        widths = [s.shape[1] for s in self.slices]

        def tile(row) -> tuple[tuple[int, int], np.ndarray]:
            return (row.shard, row.grp), np.frombuffer(bytes(row.cells), np.int32).reshape(-1, widths[row.shard])

        self.tiles = table.select("grp", "shard", "cells").rdd.map(tile).partitionBy(self.groups, self.deal)

    def assign(self) -> RDD:
        """(group, (nearest centroids, distances)) of all vectors."""
        slices = [self.context.broadcast(s) for s in self.slices]  # a task fetches those of its shards
        partial = self.tiles.map(lambda t: (t[0][1], distances(t[1], slices[t[0][0]].value)))
        return partial.reduceByKey(lambda a, b: a + b, self.groups).mapValues(nearest)

    def update(self, chosen: RDD) -> None:
        """Each shard moves its slice to the means of its columns; the slice of an empty centroid stays."""
        k, shards = self.k, len(self.slices)
        back = chosen.flatMap(lambda c: [((s, c[0]), c[1][0]) for s in range(shards)]).partitionBy(self.groups, self.deal)

        def by_shard(parts):
            """Tiles of one partition against their vectors' choices; both sides are dealt alike."""
            waiting, sums = {}, {}
            for key, value in parts:
                if key not in waiting:
                    waiting[key] = value
                    continue
                other = waiting.pop(key)
                cells, labels = (value, other) if value.ndim == 2 else (other, value)
                one = added(cells, labels, k)
                total = sums.get(key[0])
                sums[key[0]] = one if total is None else (total[0] + one[0], total[1] + one[1])
            return iter(sums.items())

        summed = self.tiles.union(back).mapPartitions(by_shard).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), shards)
        mean = summed.mapValues(lambda s: (s[0] // np.maximum(s[1], 1)[:, None], s[1] > 0))
        for shard, (means, filled) in mean.collect():  # a slice of the centroids from each shard
            filled = filled.astype(bool)
            self.slices[shard] = np.where(filled[:, None], means.astype(np.int64), self.slices[shard])


def cluster(table: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, columns: int = COLUMNS) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = table.sparkSession
    ship(spark)
    vectors = kept(table, width)
    start = seeds(vectors, k, scale)
    cut = tiles(vectors, scale, columns)
    labelled = "grp long, cluster array<int>, distance array<long>"
    if not len(start):
        chosen, model, centroids = spark.createDataFrame([], labelled), None, start
    else:
        model = Lloyd(spark, cut, start, columns)
        for _ in range(rounds):
            model.update(model.assign())
        listed = model.assign().map(lambda c: (c[0], c[1][0].tolist(), c[1][1].tolist()))
        chosen = spark.createDataFrame(listed, labelled, verifySchema=False)
        centroids = np.concatenate(model.slices, axis=1)
    pairs = F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("v")
    ids = cut.where("shard = 0").select("grp", "ids")
    found = written(ids.join(chosen, "grp").select(pairs).select("v.*"), "clustered")
    inertia = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}  # at most k rows
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(c, inertia[c], sum(inertia.values()), digest[c]) for c in inertia]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.withColumnRenamed("ids", "vec_id").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
