"""Temp tables of a session: written once, shared by the jobs that need them, removed.

The source keeps intermediate results as temp tables that later statements read until they are dropped or the session
ends. Here a job asks for a table by what it is made of: a name, the plan it derives from (``DataFrame.sameSemantics``), parameters, and the
state of the input files (:func:`casebook.sources.files.snapshot`). The first one writes it below the shared folder; others read the
same files. A table whose inputs have changed is made anew.

Each request is a lease. A table without leases stays for reuse until ``sweep`` or ``close``; one that was dropped, or replaced
because its inputs changed, goes with its last lease. What is left is removed when the driver ends, and tables of an earlier
application of the same process when the next one begins.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casebook.session import ensure_checkpoint_dir
from casebook.sources.files import Folder, input_snapshot, snapshot


@dataclass
class _Entry:
    key: tuple
    source: DataFrame
    snapshot: str
    folder: Folder
    schema: T.StructType
    leases: int = 0
    dropped: bool = False


class Lease:
    """A temp table in use. ``release`` it, or use it in a ``with`` block; its DataFrame must not be read after that."""

    def __init__(self, owner: TempTables, entry: _Entry, spark: SparkSession):
        self._owner, self._entry, self._open = owner, entry, True
        self.path = entry.folder.root
        self.df = spark.read.schema(entry.schema).parquet(self.path)

    def release(self) -> None:
        if self._open:
            self._open = False
            self._owner._released(self._entry)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *_) -> None:
        self.release()


class TempTables:
    """The temp tables of one session or of a ``with`` block."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or os.path.join(ensure_checkpoint_dir(spark), "temp", uuid.uuid4().hex)
        self._folder = Folder(spark, self.root)
        self._folder.delete_on_exit()
        self._entries: list[_Entry] = []

    def lease(self, name: str, source: DataFrame, build: Callable[[], DataFrame], params: tuple = (),
              inputs: Sequence[str] | None = None) -> Lease:
        """The table ``name`` made of ``source`` by ``build`` with ``params``. ``inputs`` are the paths that ``source`` reads
        (found from its plan, if not given: one entry a file)."""
        spark = source.sparkSession
        key = (name, tuple(params), source.semanticHash())
        now = snapshot(spark, inputs) if inputs is not None else input_snapshot(source)
        for entry in [e for e in self._entries if e.key == key and not e.dropped and e.source.sameSemantics(source)]:
            if entry.snapshot == now:
                entry.leases += 1
                return Lease(self, entry, spark)
            self._drop(entry)
        made = build()
        folder = Folder(spark, os.path.join(self.root, f"{name}-{uuid.uuid4().hex}"))
        made.write.parquet(folder.root)
        entry = _Entry(key, source, now, folder, made.schema, leases=1)
        self._entries.append(entry)
        return Lease(self, entry, spark)

    def names(self) -> list[str]:
        return sorted(e.key[0] for e in self._entries)

    def leases(self, name: str) -> int:
        return sum(e.leases for e in self._entries if e.key[0] == name)

    def drop(self, name: str) -> None:
        """DROP TABLE IF EXISTS: later requests make it anew; its files go with the last lease."""
        for entry in [e for e in self._entries if e.key[0] == name]:
            self._drop(entry)

    def sweep(self) -> None:
        """Removes the tables that nobody holds."""
        for entry in [e for e in self._entries if not e.leases]:
            self._drop(entry)

    def close(self) -> None:
        """Removes all tables, held or not."""
        self._entries.clear()
        self._folder.delete()

    def __enter__(self) -> TempTables:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _drop(self, entry: _Entry) -> None:
        entry.dropped = True
        if not entry.leases:
            self._remove(entry)

    def _released(self, entry: _Entry) -> None:
        entry.leases -= 1
        if entry.dropped and not entry.leases:
            self._remove(entry)

    def _remove(self, entry: _Entry) -> None:
        if entry in self._entries:
            self._entries.remove(entry)
            entry.folder.delete()


_SESSIONS: dict[str, TempTables] = {}


def session_tables(spark: SparkSession) -> TempTables:
    """The temp tables of this application, which all its jobs share."""
    app = spark.sparkContext.applicationId
    if app not in _SESSIONS:
        for old in list(_SESSIONS):  # applications of this process that have ended
            Folder(spark, _SESSIONS.pop(old).root).delete()
        _SESSIONS[app] = TempTables(spark)
    return _SESSIONS[app]
