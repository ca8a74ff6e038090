"""Numbered manifests: small JSON files that say which data files make up a
version of a table.

A version exists once its manifest does. A manifest is written under a name of
its own and then renamed to its number without overwriting, so of two writers of
one number only one succeeds (on HDFS and other stores with an atomic rename; the local
file system checks before it renames), and nobody reads half a manifest.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed this version."""


def path_of(spark: SparkSession, path: str):
    """(file system, path) of a folder or file on any Hadoop store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = path_of(spark, path)
    fs.delete(p, True)


class Manifests:
    """The manifests in ``folder``: ``000001.json``, ``000002.json``, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def numbers(self) -> list[int]:
        """All committed versions, ascending."""
        fs, p = path_of(self.spark, self.folder)
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:06d}.json"

    def read(self, number: int) -> dict:
        fs, p = path_of(self.spark, self._path(number))
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def latest(self) -> tuple[int, dict | None]:
        """The newest version and its manifest; (0, None) if there is none."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def commit(self, number: int, content: dict) -> None:
        """Create version ``number``; :class:`Conflict` if it exists."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, mine = path_of(self.spark, f"{self.folder}/.{uuid.uuid4().hex}.tmp")
        fs.mkdirs(mine.getParent())
        stream = fs.create(mine, True)
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(self._path(number)))
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(mine), target, how)
        except Py4JJavaError as failure:
            fs.delete(mine, False)
            if "FileAlreadyExists" in failure.java_exception.getClass().getName():
                raise Conflict(f"version {number} of {self.folder} is there already") from None
            raise

    def forget(self, number: int) -> None:
        delete(self.spark, self._path(number))
