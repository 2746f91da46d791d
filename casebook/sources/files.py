"""Files behind tables: what a set of input files looks like now, and Hadoop's file operations for small files.

Everything goes through Spark's readers or Hadoop's file system of the path, so any store that the cluster reads will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot(spark: SparkSession, paths: Sequence[str]) -> str:
    """A short text that changes when a file below ``paths`` is added, removed or rewritten (path, length, time).

    The list is made and summed up by Spark; no file is opened and one row comes back.
    """
    if not paths:
        return "no files"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    r = listed.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0)).alias("mark")).first()
    return f"{r.n} files, {r.bytes} bytes, {r.mark & (1 << 64) - 1:016x}"


def input_snapshot(df: DataFrame) -> str:
    """:func:`snapshot` of all files that ``df`` reads."""
    return snapshot(df.sparkSession, df.inputFiles())


class FileExists(Exception):
    """A file that was to be new is there already."""


class Folder:
    """Small files of one folder: list, read, create once, delete."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path().getFileSystem(self._conf)

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def subfolders(self, name: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below ``name``, relative to it."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{s.getPath().getName()}".lstrip("/") for f in found
                     for s in self._fs.listStatus(self._path(f"{name}/{f}".rstrip("/"))) if s.isDirectory()]
        return sorted(found)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create_once(self, name: str, text: str) -> None:
        """Writes ``name`` whole or not at all; :class:`FileExists` if it is there. Written aside and renamed."""
        aside = self._path(f".{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(self._path(name).getParent())
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        plain = self._gateway.new_array(fs.Options.Rename, 0)  # without OVERWRITE: fails if the target is there
        try:
            fs.FileContext.getFileContext(self._path().toUri(), self._conf).rename(aside, self._path(name), plain)
        except Py4JJavaError as e:
            self._fs.delete(aside, False)
            if e.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                raise FileExists(name) from None
            raise

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)

    def delete_on_exit(self, name: str = "") -> None:
        """Removed when the driver's JVM ends. Only folders that are there can be marked, so it is made."""
        self._fs.mkdirs(self._path(name))
        self._fs.deleteOnExit(self._path(name))
