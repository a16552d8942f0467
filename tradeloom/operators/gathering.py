"""Lines of an entity brought together once, for all that is summed per entity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.session import written

#: Lines of a task, and of an entity whose lines stay spread over many.
LINES_A_TASK, LINES_TO_SPREAD = 250_000, 1_000_000
BUCKETS = 4096


@contextmanager
def gathered(
    lines: DataFrame,
    entity: str,
    kept: bool = True,
    a_task: int = LINES_A_TASK,
    prepared: Callable[[DataFrame], DataFrame] | None = None,
) -> Iterator[tuple[DataFrame, DataFrame | None]]:
    """The lines in two frames, of different entities: those put together by entity, each one's in a single partition, and those
    of entities that have too many for it, as they came (None if there are none).

    Sums, windows and rankings per entity, or per entity and more, of the first frame need no shuffle: Spark sees how it is
    partitioned. It is shuffled once and, if it is to be `kept`, read from the executors' disks afterwards, until the end
    of the block. Missing entities count as one. Lines are counted by buckets of entities, and by entity only
    in buckets that hold too many. They move by hash: ranges would look at all of them once more. The first frame may be
    `prepared` in its partitions (sorted, say) before it is kept.
    """
    bucket = F.pmod(F.xxhash64(entity), F.lit(BUCKETS))
    counts = lines.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
    full = [r["bucket"] for r in counts if r["n"] > LINES_TO_SPREAD]
    spread = None
    if full:
        sizes = lines.filter(bucket.isin(full)).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
        large = written(sizes.filter(F.col("n") > LINES_TO_SPREAD).select(F.col(entity).alias("_large")), "large-entities")
        if not large.isEmpty():
            is_large: Column = F.col(entity).eqNullSafe(F.col("_large"))
            lines, spread = lines.join(large, is_large, "left_anti"), lines.join(large, is_large, "left_semi")
    tasks = max(1, -(-sum(r["n"] for r in counts) // a_task))
    near = lines.repartition(tasks, entity)
    near = near if prepared is None else prepared(near)
    if kept:
        near = near.persist(StorageLevel.DISK_ONLY)
    try:
        yield near, spread
    finally:
        if kept:
            near.unpersist()
