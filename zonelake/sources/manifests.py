"""Numbered manifests: small JSON files that say which folders make up a table.

A table whose folders are named by a manifest changes with one rename; a folder that no manifest names is invisible.
Files are reached through the session's Hadoop file systems, so every path that Spark reads will do.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Manifests:
    """The manifests of one table, below ``<path>/_manifests``.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self.folder = self._path(f"{self.path}/_manifests")
        self.fs = self.folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        path = self._path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.names(self.folder.toString()) if re.fullmatch(r"\d+\.json", n))

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{self.folder.toString()}/{number:020d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def write(self, number: int, body: dict) -> None:
        """Publish manifest ``number``; one that is there already is an error."""
        target = self._path(f"{self.folder.toString()}/{number:020d}.json")
        if self.fs.exists(target):
            raise FileExistsError(target.toString())
        hidden = self._path(f"{self.folder.toString()}/_{uuid.uuid4().hex}")
        stream = self.fs.create(hidden)
        try:
            stream.write(bytearray(json.dumps({**body, "number": number}).encode()))
        finally:
            stream.close()
        if not self.fs.rename(hidden, target):
            raise OSError(f"could not publish {target.toString()}")

    def remove(self, path: str) -> None:
        """Delete a file or folder of the table."""
        if not path.startswith(f"{self.path}/"):
            raise ValueError(f"{path} is not below {self.path}")
        self.fs.delete(self._path(path), True)

    def forget(self, keep: int) -> None:
        """Delete all but the newest manifests."""
        for number in self.numbers()[:-keep]:
            self.remove(f"{self.path}/_manifests/{number:020d}.json")
