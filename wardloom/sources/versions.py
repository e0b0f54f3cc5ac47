"""Numbered JSON documents in a folder: the small commit record behind tables and bookmarks.

Only the newest document counts. A commit writes a side file and renames it to the next number;
the rename refuses an existing target, so of two writers exactly one wins.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._path(folder)
        self._fs = self._folder.getFileSystem(self._conf)

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def latest(self) -> tuple[int, dict | None]:
        """Number and content of the newest document, or ``(0, None)``."""
        if not self._fs.exists(self._folder):
            return 0, None
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        return (max(numbers), self.at(max(numbers))) if numbers else (0, None)

    def at(self, number: int) -> dict:
        stream = self._fs.open(self._path(self._folder, f"{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, number: int, content: dict) -> None:
        side = self._path(self._folder, f".{uuid.uuid4().hex}")
        final = self._path(self._folder, f"{number:010d}.json")
        out = self._fs.create(side)
        try:
            out.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        no_overwrite = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(side, final, no_overwrite)
        except Exception as error:
            self._fs.delete(side, False)
            if self._fs.exists(final):
                raise CommitConflict(f"version {number} exists already in {self._folder}") from error
            raise
