"""Helpers that several operators share: words, written tables, the needed columns of a table."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tradeloom
from tradeloom.session import shared_folder

#: What separates words, the complement of [^\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text (runs of non-white characters) in order; none for an empty text."""
    spaced = F.translate(text, WHITE[1:], " " * (len(WHITE) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def without_white(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def written(frame: DataFrame, what: str) -> DataFrame:
    """The frame as a Parquet table in the folder that all executors share: computed once, and safe from lost
    executors. Each call writes a folder of its own."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def give_back() -> None:
    """Returns to the system what this process has freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def frugal(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The generator, which gives back its memory when it ends. Spark keeps a task's Python worker for later tasks, and what
    the worker has freed but holds counts for the executor."""

    @functools.wraps(run)
    def through(*args):
        try:
            yield from run(*args)
        finally:
            give_back()

    return through


_shipped: set[str] = set()


#: Texts handed to a Python worker at a time, where the session does not say otherwise. Spark's own 10,000 may be
#: gigabytes if the texts are long.
BATCH_ROWS = 1000
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, wherever the driver has it from (once an application), in
    batches that stay small."""
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tradeloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tradeloom-code-"), "tradeloom.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, name)
                packed.write(full, os.path.join("tradeloom", os.path.relpath(full, root)))
    context.addPyFile(path)  # Spark's own file server hands it out
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def blocks_for(rows: int, per_block: int) -> int:
    """How many blocks keep each near per_block rows."""
    return max(1, -(-rows // per_block))
