"""Snapshots of written tables: folders that never change, and a list of those that count.

A table, or a part of one (a month, a bucket, an entity type), is written to a folder of its own that no later write
touches. `publish` then writes one small file, the list of all parts and their folders with the next version number; the
file appears whole or not at all. Readers take the newest list, so they see all of a publication or nothing of it, and
a reader that has begun keeps its files. A writer that fails before `publish` leaves folders that no list names. `vacuum`
deletes what the newest versions do not name. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

LIST_SCHEMA = "version bigint, name string, part string, folder string"

#: Folders by table and part.
Parts = dict[tuple[str, str], str]


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _lists(self) -> list:
        reader = self.spark.read.schema(LIST_SCHEMA).option("recursiveFileLookup", "true")
        try:
            return reader.parquet(f"{self.root}/versions").collect()  # parts of the few versions that are kept
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def current(self) -> Parts:
        """Folder of each part in the newest version."""
        rows = self._lists()
        newest = max((r.version for r in rows), default=0)
        return {(r.name, r.part): r.folder for r in rows if r.version == newest and r.folder is not None}

    def folder(self, name: str) -> str:
        """A new folder for a part of the table, below the root; not there yet."""
        return f"data/{name}/v=x{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def base(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def publish(self, changes: Mapping[tuple[str, str], str | None]) -> int:
        """The next version: the newest with these parts in new folders, and without those of no folder."""
        rows = self._lists()
        version = max((r.version for r in rows), default=0)
        parts: dict = {(r.name, r.part): r.folder for r in rows if r.version == version} | dict(changes)
        listed = [(version + 1, "", "", None)]  # a version without parts is one, too
        listed += [(version + 1, *key, folder) for key, folder in parts.items() if folder is not None]
        frame = self.spark.createDataFrame(listed, LIST_SCHEMA).coalesce(1)
        frame.write.parquet(f"{self.root}/versions/{uuid.uuid4().hex}")
        return version + 1

    def vacuum(self, keep: int = 2) -> int:
        """Deletes versions but the newest ones, and folders that none of these names; tells how many folders went.

        Call it when no writer is at work; readers of older versions must be done.
        """
        rows = self._lists()
        kept = set(sorted({r.version for r in rows})[-keep:])
        named = {r.folder for r in rows if r.version in kept and r.folder is not None}  # also those that parts were made from
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())

        def inside(path) -> list:
            return [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []

        gone = 0
        for table in inside(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")):
            for written in inside(table):
                folder = f"data/{table.getName()}/{written.getName()}"
                if not any(f == folder or f.startswith(f"{folder}/") for f in named):
                    files.delete(written, True)
                    gone += 1
        for written in inside(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")):
            held = self.spark.read.schema(LIST_SCHEMA).parquet(written.toString()).first()
            if held is None or held.version not in kept:
                files.delete(written, True)
        return gone
