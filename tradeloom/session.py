"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

PARTITION_BYTES = 512 * 1024 * 1024
#: Bytes of files that a task reads where lines are summed by keys that hardly repeat: some 500,000 lines.
SUMMED_BYTES = 8 * 1024 * 1024
#: Bytes that opening a file counts for: small files of lines share a split.
OPENING_BYTES = 64 * 1024


def sized_for(input_bytes: int, shuffled_share: float = 0.1) -> dict[str, str]:
    """Settings that keep shuffle partitions near 512 MB when this share of the input is shuffled at once.

    After column pruning, period filters and sums before the shuffle a tenth is ample for the analyses; the join that
    stages the lines moves more, and states its own share. Adaptive execution merges partitions that turn out small,
    but cannot make more of them. At 100 TB the default gives 18,627 partitions for 186,265 input splits: blocks of a
    few kilobytes, where partitions for the whole input would have cut them to some hundred bytes.
    """
    partitions = max(8, -(-int(input_bytes * shuffled_share) // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES // 2),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside read files in splits of `SUMMED_BYTES`. Each task adds its rows up by key before they are shuffled; keys
    that are nearly one a line do not shrink, so the rows of a large split outgrow the task's memory and spill. Rows that
    already lie in the order of their keys are added up in it, in one pass and without a table of the keys. What a job has
    shuffled is deleted when it ends, and not when the driver happens to collect its garbage."""
    settings = {
        "spark.sql.files.maxPartitionBytes": SUMMED_BYTES,
        "spark.sql.files.openCostInBytes": OPENING_BYTES,
        "spark.sql.execution.replaceHashWithSortAgg": "true",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_local_folders: dict[str, str] = {}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("tradeloom")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir.

    Only a local session, where driver and executors are one process, may fall back to a folder
    of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tradeloom-")
    return _local_folders[context.applicationId]


def written(frame: DataFrame, what: str) -> DataFrame:
    """The frame as a table in the shared folder, in a folder of its own: computed once, safe from lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/{what}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
