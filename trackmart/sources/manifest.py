"""Numbered manifests: the commit point of tables made of immutable folders.

A table's state is the JSON file of greatest number below ``<root>/manifest``.
Data goes to fresh folders first; a commit writes the next number under a
name of its own and renames it, which fails if another writer was first. A
reader keeps the state it started with, so nothing it reads is rewritten, and
a writer that dies leaves folders that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class Manifest:
    """The manifests of one table. The file system's rename must refuse an
    existing target, as HDFS does; where a store cannot, one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/manifest/{name}")

    def versions(self) -> list[int]:
        """Numbers of the kept manifests, ascending."""
        folder = self._path(f"{self.root}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._at(f"{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict | None]:
        """The newest version and its state; ``(0, None)`` before the first."""
        versions = self.versions()
        return (versions[-1], self.read(versions[-1])) if versions else (0, None)

    def commit(self, after: int, state: dict) -> int:
        """Make ``state`` the version after ``after``; ``CommitConflict`` if
        there is one already."""
        jvm = self.spark._jvm
        made, target = self._at(f"_{uuid.uuid4().hex}"), self._at(f"{after + 1:012d}.json")
        self._fs.mkdirs(target.getParent())
        out = self._fs.create(made, False)
        try:
            out.write(json.dumps(state).encode())
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(made, target, how)
        except Exception as e:
            self._fs.delete(made, False)
            if self._fs.exists(target):
                raise CommitConflict(f"{self.root}: version {after + 1} was committed by another writer") from e
            raise
        return after + 1

    def forget(self, keep: int) -> list[dict]:
        """Delete all but the newest ``keep`` manifests; returns those kept."""
        versions = self.versions()
        for v in versions[:-keep]:
            self._fs.delete(self._at(f"{v:012d}.json"), False)
        return [self.read(v) for v in versions[-keep:]]

    def folders(self, below: str) -> list[str]:
        """Names of the folders in ``<root>/<below>``."""
        at = self._path(f"{self.root}/{below}")
        return [s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory()] if self._fs.exists(at) else []

    def remove(self, below: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{below}"), True)
